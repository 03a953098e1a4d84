"""quern: service-request analytics and text-corpus jobs as lazy Spark DataFrame code."""
