"""Secret scans: fixed formats, and a battery of randomness tests for tokens of any other format, in SQL functions only.

A token is taken for text in the smallest encoding that allows it. Three tests ask whether it could
be a uniform draw from that alphabet: chi-squared counts, runs of low and high characters, and the correlation of
neighbours. Their sum gives a p-value. Random tokens spread evenly over p, made-up names crowd near 0, so for each
encoding and length the corpus itself shows which level keeps the share of false discoveries below RATE. Copies of a
token count once there, and lengths with few tokens borrow from their neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesmart.llm.common import table, whole
from salesmart.session import materialize

KINDS = ["assign", "access", "hex", "random"]
NAMES = ["password", "passwd", "secret", "token", "api_key", "apikey"]
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX, TOKEN = r"AKIA[A-Z0-9]+", r"[0-9a-f]+", r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: The largest share of false discoveries, and the levels tried from the lowest.
RATE, LEVELS = 0.1, [0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5]
#: Distinct tokens over the lowest level that an estimate needs.
FEW = 100

#: Encodings from the smallest alphabet: name, pattern of a whole token, characters in order.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = [
    ("digits", "[0-9]+", _DIGITS),
    ("lower26", "[a-z]+", _LOWER),
    ("upper26", "[A-Z]+", _UPPER),
    ("hex", "[0-9a-f]+|[0-9A-F]+", None),
    ("base32", "[A-Z2-7]+", _UPPER + "234567"),
    ("lower36", "[a-z0-9]+", _DIGITS + _LOWER),
    ("upper36", "[A-Z0-9]+", _DIGITS + _UPPER),
    ("base62", "[A-Za-z0-9]+", _DIGITS + _UPPER + _LOWER),
    ("base64", "[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_"),
    ("mixed", ".+", _UPPER + _LOWER + _DIGITS + "+/-_"),
]


def _cut(text: Column, pattern: str, kind: int, valid, token: bool = False) -> Column:
    """The matches of ``pattern``, each with its number, the length of the text before it and its own."""
    before, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == 0 else hits
    return F.transform(
        F.arrays_zip(F.slice(before, F.lit(1), F.size(hits)).alias("gap"), hits.alias("hit"), values.alias("value")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("number"), F.length(x["gap"]).alias("gap"),
            F.length(x["hit"]).alias("size"), valid(x["value"]).alias("valid"),
            (x["hit"] if token else F.lit(None).cast("string")).alias("token")),
    )


_PIECE = "array<struct<kind:int,number:int,gap:int,size:int,valid:boolean,token:string>>"


def _candidates(text: Column) -> Column:
    """All kinds' matches; a cheap look keeps the patterns off texts that cannot match."""
    none = F.array().cast(_PIECE)
    lower = F.lower(text)
    named = F.contains(lower, F.lit(NAMES[0]))
    for name in NAMES[1:]:
        named = named | F.contains(lower, F.lit(name))
    return F.concat(
        F.when(named, _cut(text, ASSIGN, 0, lambda v: F.length(v) >= 6)).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), _cut(text, ACCESS, 1, lambda v: F.length(v) >= 20)).otherwise(none),
        F.when(text.rlike("[0-9a-f]{24}"), F.filter(_cut(text, "[0-9a-f]{24,}", 2, lambda v: F.lit(True)),
                                                    lambda x: x["valid"])).otherwise(none),
        F.when(text.rlike("[A-Za-z0-9+/_-]{20}"), _cut(text, TOKEN, 3, lambda v: F.lit(True), True)).otherwise(none),
    )


def _erfc(x: Column) -> Column:
    """The complementary error function for x >= 0, to seven digits (a standard rational approximation)."""
    t = 1 / (1 + 0.3275911 * x)
    return t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x)


def battery(frame: DataFrame) -> DataFrame:
    """``frame`` (token) with ``encoding`` and ``p``; both are null where the token is."""
    body = F.regexp_replace("token", "=+$", "")
    encoding, alphabet = F, F
    for name, pattern, chars in ENCODINGS:
        fits = F.col("body").rlike(f"^(?:{pattern})$")
        chars = F.lit(chars) if chars else F.when(F.col("body").rlike("[A-F]"), _DIGITS + "ABCDEF").otherwise(_DIGITS + "abcdef")
        encoding, alphabet = encoding.when(fits, name), alphabet.when(fits, chars)
    ready = frame.withColumn("body", body).withColumn("encoding", encoding).withColumn(
        "alphabet", F.when(F.col("encoding").isNotNull(), alphabet))
    places = F.transform(F.regexp_extract_all("body", F.lit("."), F.lit(0)), lambda c: F.instr(F.col("alphabet"), c) - 1)
    ready = ready.withColumn("x", F.when(F.col("encoding").isNotNull(), places)).withColumn(
        "k", F.length("alphabet").cast("double")).withColumn("n", F.length("body").cast("double"))
    add = lambda array, f: F.aggregate(F.transform(array, f), F.lit(0.0), lambda a, b: a + b)
    n, k, x = F.col("n"), F.col("k"), F.col("x")
    squares = add(F.array_distinct(F.regexp_extract_all("body", F.lit("."), F.lit(0))),
                  lambda c: F.pow(n - F.length(F.replace(F.col("body"), c, F.lit(""))), 2).cast("double"))
    chi = (k / n * squares - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    high = add(x, lambda v: (v * 2 >= k).cast("double"))
    turns = add(F.arrays_zip(F.slice(x, F.lit(1), F.size(x) - 1).alias("a"), F.slice(x, F.lit(2), F.size(x)).alias("b")),
                lambda v: ((v["a"] * 2 >= k) != (v["b"] * 2 >= k)).cast("double"))
    mean = add(x, lambda v: v.cast("double")) / n
    spread = add(x, lambda v: F.pow(v - F.col("mean"), 2))
    product = add(F.arrays_zip(F.slice(x, F.lit(1), F.size(x) - 1).alias("a"), F.slice(x, F.lit(2), F.size(x)).alias("b")),
                  lambda v: (v["a"] - F.col("mean")) * (v["b"] - F.col("mean")))
    ready = (
        ready.withColumn("chi", chi).withColumn("high", high).withColumn("turns", turns).withColumn("mean", mean)
        .withColumn("spread", spread).withColumn("product", product)
    )
    pairs = 2 * F.col("high") * (n - F.col("high"))
    runs = (F.col("turns") - pairs / n) / F.sqrt(F.greatest(pairs * (pairs - n) / (n * n * (n - 1)), F.lit(0.05)))
    serial = F.when(F.col("spread") > 0, (F.col("product") / F.col("spread") + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0))
    q = F.least(F.pow(F.greatest(F.col("chi"), F.lit(0.0)), 2) + F.pow(runs, 2) + F.pow(serial, 2), F.lit(600.0))
    p = _erfc(F.sqrt(F.col("q") / 2)) + F.sqrt(2 * F.col("q") / 3.141592653589793) * F.exp(-F.col("q") / 2)
    return ready.withColumn("q", q).withColumn("p", p).select(*frame.columns, "encoding", "p")


def _level(over: list[float]) -> float | None:
    """The lowest of LEVELS whose discoveries are estimated to hold at most RATE false ones, from the tokens over each.

    One is added to the tokens over one half: so a lone token needs no other to speak for it, and a few made-up names
    over a level are not taken for random ones, as no more than two go by that one."""
    for a, n in zip(LEVELS, over):
        if n > 0 and 1 - 2 * (1 - a) * (over[-1] + 1) / n <= RATE:
            return a
    return None


def pooled(counts: dict[tuple[str, int], list[float]]) -> dict[tuple[str, int], float]:
    """A level for each (encoding, bin) of ``counts``, the distinct tokens over each of LEVELS.

    A bin of fewer than FEW tokens over the lowest level borrows from the nearest bins of its encoding until there are so
    many, or no more.
    """
    found = {}
    for encoding, own in counts:
        over = [0.0] * len(LEVELS)
        bins = sorted((b for e, b in counts if e == encoding), key=lambda b: (abs(b - own), b))
        for b in bins:
            if over[0] >= FEW:
                break
            over = [x + y for x, y in zip(over, counts[encoding, b])]
        if (level := _level(over)) is not None:
            found[encoding, own] = level
    return found


def levels(tests: DataFrame) -> DataFrame:
    """(encoding, bin, level) from (encoding, bin, p, token): the lowest level whose discoveries, tokens with p over it,
    are estimated to hold at most RATE false ones. Twice the tokens over one half is how many are random. Every distinct
    token counts once, however often it is copied; ``token`` may be a hash."""
    over = [F.sum((F.col("p") >= a).cast("double")).alias(f"n{i}") for i, a in enumerate(LEVELS)]
    distinct = tests.where("encoding is not null").select("encoding", "bin", "token", "p").distinct()
    counts = {(r["encoding"], r["bin"]): list(r[2:]) for r in distinct.groupBy("encoding", "bin").agg(*over).collect()}
    rows = [F.struct(F.lit(e).alias("encoding"), F.lit(b).cast("long").alias("bin"), F.lit(a).alias("level"))
            for (e, b), a in pooled(counts).items()]
    rows = F.array(*rows).cast("array<struct<encoding:string,bin:bigint,level:double>>")
    return tests.sparkSession.range(1).select(F.inline(rows))


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, any more columns): doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start and then kind. Matches of each fixed kind are the
    leftmost non-overlapping ones, of which too short ones are dropped; ``random`` spans are added where no fixed span
    overlaps. A null or empty text has none. Rows that repeat a doc_id are rows of their own; an empty table gives an
    empty result. No secret is written to the intermediate tables, only places,
    p-values and 64-bit hashes of the tokens.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", _candidates(whole("text")).alias("found"))
    tested = battery(rows.select("row", "doc_id", F.explode_outer("found").alias("f")).select("row", "doc_id", "f.*"))
    tested = materialize(tested.withColumn("token", F.when(F.col("token").isNotNull(), F.xxhash64("token"))))
    order = Window.partitionBy("row", "kind").orderBy("number")
    start = F.sum("gap").over(order) + F.sum("size").over(order) - F.col("size")
    # Lengths in steps of a quarter of an octave up to 40, then of an octave.
    bin_ = F.when(F.col("size") < 40, F.floor(4 * F.log2(F.col("size").cast("double")))).otherwise(
        100 + F.floor(F.log2(F.col("size").cast("double"))))
    spans = tested.where("kind is not null").withColumn("start", start.cast("long")).withColumn(
        "end", (start + F.col("size")).cast("long")).withColumn("bin", bin_)
    limits = F.broadcast(levels(spans.where("kind = 3")))  # at most one row for each encoding and length bin
    kept = spans.join(limits, ["encoding", "bin"], "left").where(
        "valid and (kind < 3 or p >= level)")
    # Where the fixed spans that begin no later end, and where the next one begins: one pass each way.
    fixed = lambda c: F.when(F.col("kind") < 3, F.col(c))
    by_row = Window.partitionBy("row")
    kept = kept.withColumn("busy", F.max(fixed("end")).over(by_row.orderBy("start"))).withColumn(
        "next", F.min(fixed("start")).over(by_row.orderBy(F.desc("start")))).where(
        "kind < 3 or (coalesce(busy <= start, true) and coalesce(next >= end, true))")
    lists = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    names = F.array(*map(F.lit, KINDS))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.coalesce(F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long"), F.lit(0).cast("long"))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return (
        tested.select("row", "doc_id").distinct().join(lists, "row", "left")
        .withColumn("all", F.coalesce("all", empty)).withColumn("base", base)
        .select("doc_id", *(number(i).alias(f"n_{KINDS[i]}") for i in range(3)),
                F.sha2(joined("base"), 256).alias("base_sha256"), joined("all").alias("spans"))
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))
