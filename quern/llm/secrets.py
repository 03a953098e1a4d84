"""Secret scans with a random forest against false positives (operator 8), by DataFrame functions only.

A pattern finds candidates: long runs of letters, digits and a few signs with a digit among them, and
shorter or digit-free ones that are assigned to a telling name. A random forest rates each place of each by the
candidate's length, its changes between kinds of characters, the share of it that is made of words of the
corpus, marks of paths, and the words beside it. It is trained from labelled findings.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import fresh, quoted, sampled, stored

SIGNS = r"A-Za-z0-9_+/=\-"
#: Names that a secret of any shape is assigned to.
NAMES = "token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|access[_-]?key|private[_-]?key|secret[_-]?key|client[_-]?secret|credentials?"
LONG = rf"(?<![{SIGNS}])(?=[A-Za-z_+/=\-]*+[0-9])[{SIGNS}]{{16,}}"
#: The cheap tests stand first: few words follow a sign of assignment.
ASSIGNED = rf"""(?<![A-Za-z0-9_+/\-])(?=[A-Za-z0-9_+/\-])(?<=[=:]\s{{0,2}}["']?)(?<=(?i:{NAMES})["']?\s{{0,2}}[=:]\s{{0,2}}["']?)[{SIGNS}]{{8,}}"""
CANDIDATE = rf"(?:{LONG}|{ASSIGNED})"
#: Words beside secrets, and beside strings that only look like them.
TELLING = r"(?i)(token|secret|passw|pwd|api.?key|access.?key|private|credential|auth|bearer|signature|client.?id|key)"
HARMLESS = r"(?i)\b(commit|sha|hash|md5|digest|checksum|uuid|guid|etag|revision|build|version|example|sample|placeholder|dummy|test|file|path|http|href|src|integrity)\d*\b"
FEATURES = ["n", "changes", "cases", "digits", "uppers", "signs", "variety", "entropy", "hexadecimal", "uuid", "covered", "path", "assigned", "in_quotes", "telling", "harmless"]
#: Pieces of candidates that are broadcast to the scan for words have no more entries than this.
BROADCAST_PIECES = 500_000
REDACTED = "[REDACTED]"


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda acc, n: acc + n)


def block_sums(numbers: Column) -> Column:
    """Sums of each 64 entries."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(numbers) - 1) / 64)).cast("int")), lambda b: total(F.slice(numbers, b * 64 + 1, F.lit(64))))


def sum_before(i: Column, numbers: Column, by_64: Column, by_4096: Column) -> Column:
    """The sum of the entries before place ``i`` (from 0), from whole blocks and the rest."""
    wide, narrow = F.shiftright(i, 12), F.shiftright(i, 6)
    return total(F.slice(by_4096, F.lit(1), wide)) + total(F.slice(by_64, wide * 64 + 1, narrow - wide * 64)) + total(F.slice(numbers, narrow * 64 + 1, i - narrow * 64))


def findings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, doc, start, candidate, before, after): each place of each candidate of a text, and what is beside it; ``doc`` is a digest of the text.

    Made as small structs inside the row, from the candidates and what stands between them; only these leave it, so
    neither memory nor time grows with the square of a text. What stands before or after is put together from neighbours: each
    candidate has 8 characters at least, so five before it give 40 and two after it 16.
    """
    t, found, between, pairs = (F.col(c) for c in ("text", "found", "between", "pairs"))
    base = docs.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text")).where(t.rlike(CANDIDATE))
    parts = base.select("key", F.md5("text").alias("doc"), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("between"))
    joined = parts.select("key", "doc", "found", F.transform(between, F.length).alias("gaps"), F.transform(between, lambda x: F.right(x, F.lit(40))).alias("between"), F.zip_with(between, found, lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))).alias("pairs"))
    tails = F.transform(pairs, lambda x: F.right(x, F.lit(40)))
    heads = F.transform(pairs, lambda x: F.left(x, F.lit(16)))
    ready = joined.select("key", "doc", "found", "between", "gaps", F.transform(pairs, F.length).alias("lengths"), tails.alias("tails"), heads.alias("heads"))
    ready = ready.withColumn("by_64", block_sums(F.col("lengths")))
    # the generator keeps the optimizer from putting these arrays' making into the lambda below, once for each candidate
    made = F.struct("found", "between", "gaps", "lengths", "tails", "heads", "by_64", block_sums(F.col("by_64")).alias("by_4096"))
    ready = ready.select("key", "doc", F.explode_outer(F.array(made)).alias("r"))

    def place(c: Column, i: Column) -> Column:
        near = lambda array, at: F.coalesce(F.get(F.col(f"r.{array}"), at), F.lit(""))
        first = F.greatest(F.lit(0), i - 5)
        start = sum_before(i, F.col("r.lengths"), F.col("r.by_64"), F.col("r.by_4096")) + F.get(F.col("r.gaps"), i) + 1
        before = F.right(F.concat(F.array_join(F.slice("r.tails", first + 1, i - first), ""), near("between", i)), F.lit(40))
        after = F.left(F.concat(near("heads", i + 1), near("heads", i + 2)), F.lit(16))
        return F.struct(start.cast("long").alias("start"), c.alias("candidate"), before.alias("before"), after.alias("after"))

    places = ready.select("key", "doc", F.explode_outer(F.transform("r.found", place)).alias("p"))  # outer: a filter on its size would make it twice
    return places.select("key", "doc", "p.*")


def pieces(candidate: Column) -> Column:
    """Runs of four letters and more, at changes of case cut."""
    parts = F.regexp_extract_all(candidate, F.lit("[A-Z]?[a-z]+|[A-Z]+"), F.lit(0))
    return F.filter(F.transform(parts, F.lower), lambda p: F.length(p) >= 4)


def covered(found: DataFrame, docs: DataFrame, text: str, least_docs: int = 3) -> DataFrame:
    """(candidate, words): the characters of each distinct candidate in words that stand in ``least_docs`` texts of the corpus.

    Words are counted over all texts; only those that some candidate holds are kept, before the shuffle.
    """
    distinct = found.select("candidate").distinct()
    parts = distinct.select("candidate", F.explode(pieces(F.col("candidate"))).alias("piece"))
    wanted = stored(parts.select("piece").distinct(), "pieces")
    if wanted.count() <= BROADCAST_PIECES:
        wanted = F.broadcast(wanted)
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.col(quoted(text))), r"[^\p{L}]+"))).alias("piece")).where(F.length("piece") >= 4)
    known = words.join(wanted, "piece", "left_semi").groupBy("piece").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= least_docs)
    return parts.join(known.select("piece"), "piece").groupBy("candidate").agg(F.sum(F.length("piece")).alias("words"))


def measured(found: DataFrame) -> DataFrame:
    """Add the features; ``found`` has candidate, before, after and words (null: none known)."""
    c, n = F.col("candidate"), F.length("candidate")
    count = lambda pattern: F.regexp_count(c, F.lit(pattern))
    signs = F.filter(F.split(c, ""), lambda x: x != "")
    shares = F.transform(F.array_distinct(signs), lambda x: (n - F.length(F.replace(c, x))) / n)
    entropy = F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))
    flag = lambda column: column.cast("double")
    return found.withColumns(
        {
            "n": n.cast("double"),
            "changes": count("[0-9](?=[^0-9])|[^0-9](?=[0-9])") / n,
            "cases": count("[a-z](?=[A-Z])|[A-Z](?=[a-z])") / n,
            "digits": count("[0-9]") / n,
            "uppers": count("[A-Z]") / n,
            "signs": count("[^A-Za-z0-9]") / n,
            "variety": F.size(F.array_distinct(signs)) / n,
            "entropy": entropy,
            "hexadecimal": flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
            "uuid": flag(c.rlike("(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")),
            "covered": F.coalesce("words", F.lit(0)) / n,
            "path": flag(c.rlike("/[A-Za-z]") | F.col("before").rlike(r"[./\\]$")),
            "assigned": flag(F.col("before").rlike(r"""[=:]\s*["']?$""")),
            "in_quotes": flag(F.col("before").rlike("""["']$""") & F.col("after").rlike("""^["']""")),
            "telling": flag(F.right("before", F.lit(28)).rlike(TELLING)),
            "harmless": flag(F.right("before", F.lit(16)).rlike(HARMLESS)),
        }
    )


def generated(spark: SparkSession, docs: DataFrame, text: str, rows: int = 4_000) -> DataFrame:
    """Labelled findings (candidate, before, after, label), for corpora that bring none.

    Half are secrets: random strings of the shapes that common services give out and short passwords, most of them
    assigned to a telling name. Half are not: digests and ids by harmless names, paths, identifiers made of words
    of the corpus, words assigned to telling names, placeholders, runs of one sign. The random parts are digests of
    the row's number; the words are at most 400, chosen by a hash, of a sample of about 50 texts.
    """
    some = sampled(docs.select(F.col(quoted(text)).alias("t")).where("t is not null"), "t", 50).select(F.explode(F.split(F.lower("t"), r"[^a-z]+")).alias("w"))
    words = some.where(F.length("w").between(4, 9)).distinct().orderBy(F.xxhash64("w")).limit(400)
    base = spark.range(rows).withColumn("list", F.split(F.lit(" ".join(r["w"] for r in words.collect()) or "plain"), " "))
    r = lambda salt: F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    b64 = lambda salt: F.regexp_replace(F.base64(F.unhex(F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 512))), r"\s", "")
    pick = lambda salt, options: F.element_at(F.array(*map(F.lit, options)), (F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(options))) + 1).cast("int"))
    size = F.greatest(F.size("list"), F.lit(1))
    word = lambda salt: F.coalesce(F.try_element_at("list", (F.pmod(F.xxhash64(F.lit(salt), "id"), size) + 1).cast("int")), F.lit("plain"))
    number = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n)).cast("string")
    plain = F.regexp_replace(b64("p"), "[+/=]", "")
    letters = F.regexp_replace(b64("l"), "[^A-Za-z]", "")
    shapes = [
        F.substring(r("a"), 1, 40),
        F.substring(r("a"), 1, 32),
        r("a"),
        F.substring(b64("b"), 1, 40),
        b64("b"),
        F.concat(F.lit("AKIA"), F.upper(F.substring(F.regexp_replace(b64("c"), "[^A-Z2-7]", ""), 1, 16)), F.lit("7")),
        F.concat(F.lit("ghp_"), F.substring(plain, 1, 36)),
        F.concat(F.lit("sk-"), F.substring(plain, 1, 48)),
        F.concat(F.lit("xoxb-"), number("x", 10**12), F.lit("-"), F.substring(plain, 1, 24)),
        F.substring(plain, 1, 10),
        F.substring(letters, 1, 14),
        F.concat(word("8"), F.initcap(word("9")), number("z", 10**4)),
    ]
    harmless = [
        F.substring(r("d"), 1, 40),
        r("d"),
        F.regexp_replace(F.substring(r("d"), 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"),
        F.concat(word("1"), F.lit("/"), word("2"), F.lit("/"), word("3"), number("n", 100)),
        F.concat(word("1"), F.lit("_"), word("2"), F.lit("_"), word("3"), number("n", 1000)),
        F.concat(word("1"), F.initcap(word("2")), F.initcap(word("3")), number("n", 10)),
        F.lpad(number("n", 10**9), 18, "0"),
        F.rpad(number("n", 10), 20, "x"),
        F.concat(F.lit("2024-01-"), number("n", 28), F.lit("T00-00-00-"), word("1")),
        F.concat(word("1"), word("2"), word("3"), number("n", 100)),
    ]
    # words and placeholders stand assigned to telling names as well
    named = [F.concat(word("1"), F.lit("_"), word("2")), F.concat(word("1"), word("2")), pick("v", ["required", "undefined", "changeme", "xxxxxxxx", "your_password", "placeholder", "********"])]
    chosen = lambda options, salt: F.element_at(F.array(*options), (F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(len(options))) + 1).cast("int"))
    secret = F.col("id") % 2 == 0
    assigned = F.concat(pick("t", ["token", "api_key", "secret", "password", "auth_token", "client_secret", "AWS_SECRET_ACCESS_KEY", "key"]), pick("u", [" = \"", "=", ": ", " = '", "\": \"", "='"]))
    beside = F.concat(pick("h", ["commit ", "sha256: ", "id=", "see file ", "build ", "checksum = \"", "uuid: ", "version ", "the path is ./", "digest=\"", ""]))
    loose = F.concat(word("4"), F.lit(" "), word("5"), F.lit(" "))
    often = F.pmod(F.xxhash64(F.lit("o"), "id"), F.lit(10)) < 9
    shaped = F.pmod(F.xxhash64(F.lit("s"), "id"), F.lit(len(harmless)))
    before = F.when(secret, F.concat(loose, F.when(often, assigned).otherwise(F.lit("Bearer ")))).otherwise(F.concat(loose, F.when((shaped >= 3) & ~often, assigned).otherwise(beside)))
    after = F.when(F.col("before").rlike("\"$"), F.lit("\" ")).when(F.col("before").rlike("'$"), F.lit("' ")).otherwise(F.lit(" "))
    plainly = F.pmod(F.xxhash64(F.lit("m"), "id"), F.lit(6)) == 0
    shape = F.when(secret, chosen(shapes, "k")).when(plainly, chosen(named, "w")).otherwise(F.element_at(F.array(*harmless), (shaped + 1).cast("int")))
    place = F.when(~secret & plainly, F.concat(loose, assigned)).otherwise(before)
    made = base.select(shape.alias("candidate"), place.alias("before"), secret.cast("double").alias("label"))
    return made.withColumn("after", after).where(F.concat("before", "candidate").rlike(CANDIDATE))


def train(labelled: DataFrame, trees: int = 40, depth: int = 8) -> PipelineModel:
    """Fit the forest on measured findings with ``label`` (1: a secret)."""
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=11)
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(labelled)


def rated(docs: DataFrame, key: str, text: str, labelled: DataFrame | None) -> DataFrame:
    """The findings with ``score``, the forest's vote on each by its own neighbours."""
    found = stored(findings(docs, key, text), "findings")
    known = generated(docs.sparkSession, docs, text) if labelled is None else labelled.select("candidate", "before", "after", F.col("label").cast("double").alias("label"))
    both = stored(found.select("candidate").union(known.select("candidate")).distinct(), "candidates")
    words = stored(covered(both, docs, text), "covered")
    model = train(measured(known.join(words, "candidate", "left")))
    return model.transform(measured(found.join(words, "candidate", "left"))).select("key", "doc", "start", "candidate", vector_to_array("probability")[1].alias("score"))


def occurrences(docs: DataFrame, key: str = "doc_id", text: str = "text", labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """(key, start, length, secret, score, is_secret): each place of each candidate of each row's whole text, rated by what is beside it there.

    ``start`` counts characters from 1. Null and empty texts and an empty table give no rows; a null key is kept;
    rows that repeat give repeated findings; other columns are not looked at.
    """
    score = F.col("score")
    return rated(docs, key, text, labelled).select(F.col("key").alias(key), "start", F.length("candidate").alias("length"), F.col("candidate").alias("secret"), "score", (score >= threshold).alias("is_secret"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """(key, start, length, secret, score, is_secret): each distinct candidate of each row's whole text.

    ``start`` counts characters from 1 and is the first place; ``score`` is the forest's highest vote over all
    places of the candidate in the text. ``labelled`` has candidate, before, after and label (without it,
    findings are generated). Null and empty texts have no candidates; a null key is kept; rows that
    repeat give repeated findings. Other columns are not looked at.
    """
    places = rated(docs, key, text, labelled).groupBy("key", "doc", "candidate", "start").agg(F.max("score").alias("score"), F.count(F.lit(1)).alias("times"))
    highest = places.groupBy("key", "doc", "candidate").agg(F.min("start").alias("start"), F.max("score").alias("score"), F.max("times").alias("times"))
    each = highest.select("key", "start", "candidate", "score", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
    return each.select(F.col("key").alias(key), "start", F.length("candidate").alias("length"), F.col("candidate").alias("secret"), "score", (F.col("score") >= threshold).alias("is_secret"))


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """All rows of ``docs`` with their secrets replaced by ``[REDACTED]``, and ``n_chars`` brought up to date.

    A candidate that is a secret in one place of a text is replaced in all places where it is a candidate of that
    text, and nowhere inside a longer run. Rows without a candidate, null and empty texts pass
    through as they are; rows that repeat are redacted alike; all columns stay, whatever their names.
    """
    name, digest, bad = fresh(docs, "owner"), fresh(docs, "digest"), fresh(docs, "secrets")
    places = rated(docs, key, text, None).groupBy("key", "doc", "candidate", "start").agg(F.max("score").alias("score"))
    told = places.groupBy("key", "doc", "candidate").agg((F.max("score") >= 0.5).alias("bad"), F.collect_list("start").alias("starts"))
    flags = told.select("key", "doc", "bad", F.explode("starts").alias("start")).groupBy("key", "doc").agg(F.array_sort(F.collect_list(F.struct("start", "bad"))).alias("flags"), F.max("bad").alias("some"))
    secrets = flags.where("some").select(F.col("key").alias(name), F.col("doc").alias(digest), F.transform("flags", lambda x: x["bad"]).alias(bad))
    t = F.col(quoted(text))
    has = F.coalesce(t.rlike(CANDIDATE), F.lit(False))
    some = docs.where(has).join(secrets, F.col(quoted(key)).eqNullSafe(F.col(name)) & (F.md5(t) == F.col(digest)), "left")
    # every candidate of a text has a flag, in order
    found, between = F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)), F.split(t, CANDIDATE, -1)
    clean = F.zip_with(found, F.col(bad), lambda c, on: F.when(on, F.lit(REDACTED)).otherwise(c))
    whole = F.array_join(F.zip_with(between, clean, lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")
    columns = {text: F.when(F.col(bad).isNull(), t).otherwise(whole)}
    if n_chars and n_chars in docs.columns:
        columns[n_chars] = F.when(F.col(bad).isNull(), F.col(quoted(n_chars))).otherwise(F.length(whole).cast(docs.schema[n_chars].dataType))
    return some.select(*[columns[c].alias(c) if c in columns else F.col(quoted(c)) for c in docs.columns]).union(docs.where(~has))
