"""Main text of web pages by a recurrent block labeller (operator 10).

A page is cut into blocks: the texts between tags that start or end a block. A bidirectional LSTM, written
in numpy, reads the sequence of all blocks of a page; of each it gets the hashed parts of its path of
tags (names, classes, ids), its hashed words and a few numbers such as the share of text in links. It
labels every block as main text or not, knowing what stands before and after. It is trained on pages
composed from the texts of a bounded sample of pages, in many layouts whose parts are known.
"""

from __future__ import annotations

import html as entities
import random
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import quoted, sampled_rows, with_python_columns

#: Elements that only style text, those without an end tag, and those whose content is never shown as text.
INLINE = set("a abbr acronym b bdi bdo big br cite code data dfn em font i img ins del kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: MathML is text of its line.
INLINE |= set("math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style template noscript title textarea select option iframe object svg canvas audio video annotation annotation-xml".split())
#: Hidden elements of which, without an end tag, only the tag is dropped.
ENDED = {n: regex.compile(rf"</{n}\s*>", regex.IGNORECASE) for n in "select object svg canvas audio video annotation annotation-xml".split()}

TOKEN = regex.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(?P<raw>script|style|template|noscript|title|textarea|iframe)(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*>|$)"
    r"""|<(?P<end>/?)(?P<name>[a-z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(?P<end2>/?)(?P<name2>[a-z][^\s/>]*)(?P<rest2>[^>]*+)>"
    r"|<[!?/][^>]*+>",
    regex.IGNORECASE | regex.DOTALL,
)
ATTRIBUTE = regex.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", regex.IGNORECASE)
PARTS = regex.compile(r"[a-z]+", regex.IGNORECASE)

PATH_DIMS, WORD_DIMS, OTHER_DIMS, HIDDEN_UNITS = 96, 48, 8, 16
DIMS = PATH_DIMS + WORD_DIMS + OTHER_DIMS
#: Paths and words that a worker remembers before it starts anew.
MEMO = 1 << 17


def place(name: str, dims: int) -> int:
    return xxhash.xxh32_intdigest(name) % dims


def element(name: str, rest: str) -> tuple[str, ...]:
    """What the labeller sees of a tag: its name, and the words of its class, id and role."""
    words = [w.lower() for _, *v in ATTRIBUTE.findall(rest) for w in PARTS.findall("".join(v))] if "=" in rest else []
    return (name, *("." + w[:6] for w in words))


def blocks(page: str) -> list[tuple[tuple[tuple[str, ...], ...], str, int]]:
    """(path of elements, text, characters in links) of each block with text, in page order.

    Character references are decoded, white space runs become one space. Tags that are left open end
    with their parent; a paragraph ends where the next block begins.
    """
    found: list[tuple[tuple[tuple[str, ...], ...], str, int]] = []
    path: list[tuple[str, ...]] = []
    pieces: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                found.append((tuple(path), text, linked))
            pieces.clear()
        linked = 0

    at = 0
    endless: set[str] = set()
    while m := TOKEN.search(page, at):
        if m.start() > at:
            piece = page[at : m.start()]
            pieces.append(piece)
            if links:
                linked += len(piece)
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name or name in HIDDEN:
            if m["raw"]:
                flush()
            elif name in ENDED and name not in endless and not (m["end"] or m["end2"]) and not (name == "svg" and (m["rest"] or m["rest2"] or "").endswith("/")):
                closed = ENDED[name].search(page, at)
                if closed:
                    flush()
                    at = closed.end()
                else:
                    endless.add(name)
            continue
        end = m["end"] or m["end2"]
        if name == "a":
            links = 0 if end else 1
        if name in INLINE:
            if name in ("br", "img", "wbr"):
                pieces.append(" ")
            continue
        flush()
        links = 0
        if end:
            for k in range(len(path) - 1, -1, -1):
                if path[k][0] == name:
                    del path[k:]
                    break
        else:
            if path and path[-1][0] in ("p", "li", "dt", "dd", "td", "th", "tr", "option") and (name == path[-1][0] or path[-1][0] == "p"):
                path.pop()
            if name not in VOID:
                path.append(element(name, m["rest"] or m["rest2"] or ""))
    pieces.append(page[at:])
    flush()
    return found


class Features:
    """Vectors of blocks; remembers those of paths and the places of words."""

    def __init__(self) -> None:
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, int] = {}

    def path(self, path: tuple) -> np.ndarray:
        v = self.paths.get(path)
        if v is None:
            if len(self.paths) >= MEMO:
                self.paths.clear()
            v = np.zeros(PATH_DIMS, dtype=np.float32)
            for depth, e in enumerate(path):
                for part in e:
                    v[place(part, PATH_DIMS)] += 1.0 if depth < len(path) - 1 else 0.5
            self.paths[path] = v = np.minimum(v, 2)
        return v

    def word(self, w: str) -> int:
        k = self.words.get(w)
        if k is None:
            if len(self.words) >= MEMO:
                self.words.clear()
            k = self.words[w] = place(w.lower(), WORD_DIMS)
        return k

    def of(self, found: list[tuple]) -> np.ndarray:
        """One row for each block of a page."""
        x = np.zeros((len(found), DIMS), dtype=np.float32)
        for i, (path, text, linked) in enumerate(found):
            words = text.split(" ")
            n = len(words)
            row = x[i]
            row[:PATH_DIMS] = self.path(path)
            row[PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.bincount([self.word(w) for w in words], minlength=WORD_DIMS) / n**0.75
            row[PATH_DIMS + WORD_DIMS :] = (np.log1p(n) / 4, np.log1p(len(text)) / 8, min(1, linked / max(1, len(text))), text[-1] in ".!?…:;", n < 4, n > 15, i / len(found), 1)
        return x


class Labeller:
    """The network's weights: for each direction an LSTM, and a logistic output over both."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        h = HIDDEN_UNITS
        self.w = {f"{d}{k}": rng.normal(0, 0.5 / np.sqrt(n), (n, 4 * h)).astype(np.float32) for d in "fb" for k, n in (("x", DIMS), ("h", h))}
        self.w |= {f"{d}b": np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(np.float32) for d in "fb"}
        self.w |= {"o": rng.normal(0, 0.2, 2 * h).astype(np.float32), "ob": np.zeros(1, dtype=np.float32)}

    def _scan(self, x: np.ndarray, mask: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States of one direction over (time, pages, features); a padded step leaves the state as it is."""
        h = HIDDEN_UNITS
        inner = x @ self.w[d + "x"] + self.w[d + "b"]
        state, cell = np.zeros((2, x.shape[1], h), dtype=np.float32)
        out, steps = np.zeros((*x.shape[:2], h), dtype=np.float32), []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            z = inner[t] + state @ self.w[d + "h"]
            gates = 1 / (1 + np.exp(-z[:, : 3 * h]))
            i, f, o, g = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :], np.tanh(z[:, 3 * h :])
            new = f * cell + i * g
            m = mask[t][:, None]
            steps.append((t, state, cell, i, f, o, g, np.tanh(new), m))
            state, cell = m * (o * steps[-1][7]) + (1 - m) * state, m * new + (1 - m) * cell
            out[t] = state
        return out, steps

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        (f, sf), (b, sb) = self._scan(x, mask, "f"), self._scan(x, mask, "b")
        both = np.concatenate([f, b], axis=2)
        return 1 / (1 + np.exp(-(both @ self.w["o"] + self.w["ob"]))), [both, sf, sb]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss, by backpropagation through time."""
        p, (both, sf, sb) = self.forward(x, mask)
        h = HIDDEN_UNITS
        off = (p - y) * mask / mask.sum()
        g = {"o": np.einsum("tn,tnk->k", off, both), "ob": np.array([off.sum()])}
        up = off[:, :, None] * self.w["o"]
        for d, steps, part in (("f", sf, up[:, :, :h]), ("b", sb, up[:, :, h:])):
            dz_all = np.zeros((*x.shape[:2], 4 * h), dtype=np.float32)
            dw = np.zeros_like(self.w[d + "h"])
            dstate, dcell = np.zeros((2, x.shape[1], h), dtype=np.float32)
            for t, state, cell, i, f, o, c, tanh, m in reversed(steps):
                ds = dstate + part[t]
                dnew = m * (ds * o * (1 - tanh**2) + dcell)
                dz = np.concatenate([dnew * c * i * (1 - i), dnew * cell * f * (1 - f), m * ds * tanh * o * (1 - o), dnew * i * (1 - c**2)], axis=1)
                dw += state.T @ dz
                dstate = dz @ self.w[d + "h"].T + (1 - m) * ds
                dcell = dnew * f + (1 - m) * dcell
                dz_all[t] = dz
            g[d + "x"] = np.einsum("tnk,tnj->kj", x, dz_all, optimize=True)
            g[d + "h"], g[d + "b"] = dw, dz_all.sum(axis=(0, 1))
        return g

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 14, batch: int = 32, seed: int = 4) -> None:
        """Adam over mini-batches of pages."""
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        t = 0
        for _ in range(rounds):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), batch):
                some = [pages[i] for i in order[at : at + batch]]
                x, mask = padded([p[0] for p in some])
                y = np.zeros(mask.shape, dtype=np.float32)
                for k, (_, own) in enumerate(some):
                    y[: len(own), k] = own
                t += 1
                for k, g in self.gradients(x, mask, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g**2
                    self.w[k] = (self.w[k] - 0.01 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)

    def label(self, pages: list[np.ndarray], cells: int = 8192) -> list[np.ndarray]:
        """For each page, whether each block is main text. Pages of like length go together, whole."""
        out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            n = max(1, cells // len(pages[order[-1]]))
            some, order = order[-n:], order[:-n]
            p, _ = self.forward(*padded([pages[i] for i in some]))
            for k, i in enumerate(some):
                out[i] = p[: len(pages[i]), k] > 0.5
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(len(p) for p in pages), len(pages), DIMS), dtype=np.float32)
    mask = np.zeros(x.shape[:2], dtype=np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], mask[: len(p), k] = p, 1
    return x, mask


# How the parts of a page are commonly marked. "tag" or "tag.class"; a part's layout takes one of them.
MAIN = "article main div.content div.post div.entry-content section.article-body div.story div.main-content div.text td.content section".split()
HEAD = "header div.header div.masthead div.banner div.topbar header.site-header".split()
MENU = "nav div.nav div.menu ul.menu nav.navbar div.breadcrumb div.navigation".split()
SIDE = "aside div.sidebar div.widget aside.related div.recommended section.related div.rail div.share div.tags".split()
AD = "div.ad div.advert aside.promo div.sponsored div.ads div.advertisement section.promo ins.adsbygoogle".split()
NOTICE = "div.notice div.cookie-banner div.alert section.consent div.newsletter div.popup div.message aside.notice div.disclaimer".split()
FORM = "form form.search form.signup div.form form.login".split()
REPLIES = "section.comments div.comments ol.comment-list div.comment div.discussion div.responses ul.replies section.reactions".split()
FOOT = "footer div.footer div.copyright footer.site-footer div.bottom".split()
SHORT = "Home|About|Contact|Log in|Sign up|Search|Share|Next|Previous|Menu|More|Subscribe|Archive|Help|Privacy|Terms|News|Shop|Jobs|RSS".split("|")
NOTES = "We use cookies on this site.|Accept all|Subscribe to our newsletter|Please log in to comment.|All rights reserved.|Advertisement|Read more|Related articles|Leave a reply|Your email address|Share this article|Sponsored|Sign up for updates|Copyright|Follow us".split("|")


def tag(marked: str, inner: str, rng: random.Random) -> str:
    name, _, cls = marked.partition(".")
    kind = rng.choice(("class", "class", "id"))
    return f'<{name} {kind}="{cls}">{inner}</{name}>' if cls else f"<{name}>{inner}</{name}>"


def composed(main: list[str], other: list[str], rng: random.Random) -> list[tuple[list, np.ndarray]]:
    """A page in a layout drawn at random: the blocks of its parts, and which of them are main text."""
    esc = entities.escape
    good, bad = "\ue001", "\ue000"  # marks of private use, taken off again below

    def para(text: str, mark: str) -> str:
        t = mark + esc(text)
        if rng.random() < 0.2 and " " in t:
            head, _, rest = t.partition(" ")
            t = f"{head} <{(x := rng.choice(('b', 'em', 'a', 'span')))}>{rest}</{x}>"
        if rng.random() < 0.1:
            t = "<b>" + t + rng.choice(("</b>", "<br>", ""))
        return t

    def items(n: int) -> str:
        texts = [rng.choice(SHORT) if rng.random() < 0.4 else " ".join(rng.choice(other).split()[: rng.randint(1, 4)]) for _ in range(n)]
        return "".join(f'<li><a href="#">{bad}{esc(t)}</a></li>' for t in texts)

    def some(n: int) -> str:
        texts = [rng.choice(NOTES) if rng.random() < 0.4 else rng.choice(other) for _ in range(n)]
        return "".join((f"<{(p := rng.choice(('p', 'p', 'div', 'h3', 'li')))}>{para(t, bad)}</{p}>" if rng.random() < 0.6 else para(t, bad) + "<hr>") for t in texts)

    menu = lambda: tag(rng.choice(MENU), f"<ul>{items(rng.randint(2, 9))}</ul>", rng)
    body = [f"<h{k}>{para(' '.join(main[0].split()[:9]), good)}</h{k}>" for k in [rng.randint(1, 2)] if rng.random() < 0.8]
    for t in main:
        kind = rng.random()
        if kind < 0.75:
            body.append(f"<p>{para(t, good)}" + rng.choice(("</p>", "</p>", "</p>", "")))
        elif kind < 0.85:
            body.append("<ul>" + "".join(f"<li>{good}{esc(x)}</li>" for x in t.split(". ")[:6] if x.strip()) + "</ul>")
        else:
            x = rng.choice(("blockquote", "pre", "h3", "div", "section", "figcaption"))
            body.append(f"<{x}>{para(t, good)}</{x}>")
        if rng.random() < 0.06:
            body.append(tag(rng.choice(AD + SIDE + NOTICE), some(1), rng))
    holder = tag(rng.choice(MAIN) if rng.random() < 0.5 else "article", "".join(body), rng)
    if rng.random() < 0.3:
        holder = f'<div class="{rng.choice(("wrapper", "page", "container", "row"))}">{holder}</div>'
    before = [menu()] if rng.random() < 0.9 else []
    before += [tag(rng.choice(x), some(1), rng) for x, p in ((HEAD, 0.4), (AD, 0.5), (NOTICE, 0.4), (FORM, 0.2)) if rng.random() < p]
    after = [tag(rng.choice(x), some(rng.randint(1, k)), rng) for x, p, k in ((SIDE, 0.5, 3), (AD, 0.3, 1), (REPLIES, 0.5, 5), (FORM, 0.3, 2), (NOTICE, 0.3, 2), (FOOT, 0.85, 2)) if rng.random() < p]
    if rng.random() < 0.3:
        after.insert(0, menu())
    rng.shuffle(before)
    if rng.random() < 0.3:
        before, after = before + after[:1], after[1:]
    page = "<html><head><title>x</title></head><body>" + "".join(before) + holder + "".join(after) + "</body></html>"
    found, label = [], []
    for path, text, linked in blocks(page):
        if text[0] in (good, bad) and text.lstrip(good + bad).strip():
            found.append((path, text.replace(good, "").replace(bad, "").strip(), linked))
            label.append(text[0] == good)
    return found, np.array(label, dtype=np.float32)


def fit(pages: DataFrame, html: str = "html", key: str = "page_id", bound: int = 400, composed_pages: int = 700, most_bytes: int = 16 << 20) -> Labeller:
    """Train on ``composed_pages`` pages composed from the texts of a bounded sample of pages.

    The sample has about ``bound`` pages and ``most_bytes`` of HTML at most, with all their blocks whole; pages of
    over a sixteenth of that are not learned from. Null pages and keys are left out, repeated rows count again,
    and an empty table trains on one built-in sentence.
    """
    plain = pages.where(F.col(quoted(html)).isNotNull() & F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).alias("key"), F.col(quoted(html)).alias("html"))
    sample = sampled_rows(plain, bound, F.octet_length("html"), most_bytes)

    def make() -> Callable:
        return lambda columns: [pa.array([[t for _, t, _ in blocks(h)] for h in columns[0].to_pylist()], pa.list_(pa.string()))]

    rows = with_python_columns(sample, ["html"], [T.StructField("texts", T.ArrayType(T.StringType()))], make, drop=("html",)).orderBy("key").collect()
    texts = [t for r in rows for t in r["texts"] if len(t) > 60] or ["A few plain words that stand for the text of a page, and nothing else."]
    rng = random.Random(8)
    vectors, model, train = Features(), Labeller(), []
    for _ in range(composed_pages):
        main = [rng.choice(texts) if rng.random() < 0.85 else " ".join(rng.choice(texts).split()[: rng.randint(1, 6)]) for _ in range(min(30, 1 + int(rng.expovariate(0.15))))]
        other = [" ".join(rng.choice(texts).split()[: rng.choice((2, 5, 8, 20, 50))]) for _ in range(6)]
        found, label = composed(main, other, rng)
        if found:
            train.append((vectors.of(found), label))
    model.train(train)
    return model


def extract(df: DataFrame, model: Labeller, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Add ``text`` (the main blocks in page order, joined by line feeds) and ``n_chars`` (its code points).

    A null or empty page, or one without main text, has an empty text. Whole pages are read and whole
    blocks given. Rows are kept one for one; columns of the outputs' names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        labeller, vectors = shared.value, Features()

        def step(columns):
            found = [blocks(h) if h else [] for h in columns[0].to_pylist()]
            labels = labeller.label([vectors.of(f) for f in found])
            texts = ["\n".join(t for (_, t, _), on in zip(f, label.tolist(), strict=True) if on) for f, label in zip(found, labels, strict=True)]
            return pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())

        return step

    return with_python_columns(df, [html], [T.StructField(text, T.StringType()), T.StructField(n_chars, T.LongType())], make)
