"""Secret scans, native: base patterns and character Markov models.

Two first-order character models, one of random strings (trained on the values
that the base patterns label) and one of ordinary identifiers and words
(trained on a bounded sample of documents), are compared by log-likelihood
ratio.  Long tokens that the random model explains far better become spans of
kind ``random``.  All work is DataFrame functions; offsets of matches come from
the lengths of the pieces between them, summed in a window per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import hash_sample, materialise, row_keys

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = ("assign", "access", "hex", "random")
#: With the least length inside: a run is matched whole or not at all, so this
#: equals matching runs of any length and dropping the short ones.  That does
#: not hold for assignments, whose failing matches still use up their text.
PATTERNS = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}", "random": "[A-Za-z0-9+/_=-]{16,}"}
#: Cheap tests that a text may have a match; others skip the kind.
GUARDS = {"assign": "[:=]", "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}", "random": "[A-Za-z0-9+/_=-]{16}"}
LEAST_VALUE = 6
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
ALPHA, KAPPA = 0.5, 10.0
#: Documents of which the ordinary model is trained.
SAMPLE_DOCS = 4000
#: Log odds a token needs in all, and per character.
TOTAL_ODDS, CHAR_ODDS = 10.0, 0.4


def _matches(text: Column, kind: str) -> Column:
    """array<struct(kind, i, gap, match)> of all matches; gap is the length of
    the text since the match before."""
    gaps = F.transform(F.split(text, PATTERNS[kind], -1), lambda p: F.length(p))
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("match"), gaps.alias("gap"))
    rows = F.transform(both, lambda m, i: F.struct(
        F.lit(KINDS.index(kind)).alias("rank"), i.alias("i"), m["gap"].alias("gap"), m["match"].alias("match")))
    rows = F.filter(rows, lambda m: m["match"].isNotNull())  # the piece after the last match
    none = F.array().cast("array<struct<rank:int,i:int,gap:int,match:string>>")
    return F.when(text.rlike(GUARDS[kind]), rows).otherwise(none)


def raw_spans(docs: DataFrame) -> DataFrame:
    """(did, th, rank, start, end, match) of all matches that are long enough.

    Only lengths and the matches themselves are shuffled, by document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = row_keys(docs).select("_did", "_th", F.explode(F.concat(*[_matches(text, k) for k in KINDS])).alias("m"))
    rows = found.select(F.col("_did").alias("did"), F.col("_th").alias("th"), "m.rank", "m.i", "m.gap",
                        F.length("m.match").alias("len"),
                        F.when(F.length("m.match") >= LEAST_VALUE, F.col("m.match")).alias("match"))
    rows = rows.repartition("did", "th").dropDuplicates(["did", "th", "rank", "i"])
    order = Window.partitionBy("did", "th", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(order)).withColumn("start", F.col("end") - F.col("len"))
    value = F.when(F.col("rank") == 0, F.regexp_extract("match", ASSIGN, 1)).otherwise(F.col("match"))
    rows = rows.withColumn("value", value).filter((F.col("rank") > 0) | (F.length("value") >= LEAST_VALUE))
    return rows.filter((F.col("rank") < 3) | F.col("match").rlike("[A-Za-z]")).select("did", "th", "rank", "start", "end", "value")


def bigrams(tokens: DataFrame) -> DataFrame:
    """(token, pair) for every two neighbouring characters of ``token``."""
    chars = F.filter(F.split("token", ""), lambda c: c != "")
    pairs = F.transform(F.slice("_c", 1, F.greatest(F.size("_c") - 1, F.lit(0))), lambda c, i: F.concat(c, F.get("_c", i + 1)))
    return tokens.withColumn("_c", chars).select("token", F.explode(pairs).alias("pair"))


def pair_counts(tokens: DataFrame, name: str) -> DataFrame:
    return bigrams(tokens).groupBy("pair").agg(F.count(F.lit(1)).alias(name))


def model(random: DataFrame, ordinary: DataFrame) -> DataFrame:
    """(pair, weight): log ratio of the two models' transition probabilities, one
    row for every pair of the alphabet (at most 67 * 67 rows, whatever the input)."""
    spark = random.sparkSession
    letters = F.array(*[F.lit(c) for c in ALPHABET])
    grid = spark.range(1).select(F.explode(letters).alias("a")).select("a", F.explode(letters).alias("b"))
    grid = grid.select("a", "b", F.concat("a", "b").alias("pair"))
    both = (grid.join(pair_counts(random, "r"), "pair", "left").join(pair_counts(ordinary, "o"), "pair", "left")
            .fillna(0, ["r", "o"]))
    before, after = Window.partitionBy("a"), Window.partitionBy("b")
    p = {}
    for c in ("r", "o"):  # transitions interpolated with the frequency of the second character
        single = (F.sum(c).over(after) + ALPHA) / (F.sum(c).over(Window.partitionBy(F.lit(1))) + ALPHA * len(ALPHABET))
        p[c] = (F.col(c) + KAPPA * single) / (F.sum(c).over(before) + KAPPA)
    return both.select("pair", (F.log(p["r"]) - F.log(p["o"])).alias("weight"))


def train(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Models of the labelled samples: values of base spans against words of a
    bounded sample of documents that do not mix letters with digits and are no
    base value."""
    random = spans.filter("rank < 3").select(F.col("value").alias("token")).distinct()
    sample = hash_sample(docs.filter("doc_id is not null and text is not null"), SAMPLE_DOCS)
    words = sample.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z0-9+/_=-]{6,}"), F.lit(0))).alias("token"))
    plain = words.filter(~(F.col("token").rlike("[A-Za-z]") & F.col("token").rlike("[0-9]")))
    return model(random, plain.join(random, "token", "left_anti"))


def secret_spans(docs: DataFrame) -> DataFrame:
    """(did, th, rank, start, end) of base spans and of the random tokens that
    overlap none of them."""
    spans = materialise(raw_spans(docs), "spans")
    weights = F.broadcast(materialise(train(docs, spans), "pairs"))
    tokens = spans.filter("rank = 3").select(F.col("value").alias("token")).distinct()
    score = (bigrams(tokens).join(weights, "pair").groupBy("token").agg(F.sum("weight").alias("odds")))
    risky = score.filter((F.col("odds") >= TOTAL_ODDS) & (F.col("odds") >= CHAR_ODDS * F.length("token"))).select("token")
    extra = spans.filter("rank = 3").join(risky, spans.value == risky.token, "left_semi")
    return spans.filter("rank < 3").unionByName(extra).select("did", "th", "rank", "start", "end")


def _count(spans: Column, rank: int) -> Column:
    return F.size(F.filter(spans, lambda s: s.rank == rank)).cast("long")


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s.rank), s.start.cast("string"), s.end.cast("string"))), ",")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """``documents`` -> one row each: doc_id, n_assign, n_access, n_hex, n_random,
    base_sha256, spans.

    Offsets count code points, the end is exclusive; spans are ordered by start,
    then kind (assign, access, hex, random).  Null and empty texts have no span;
    repeated rows get the same answer; without any base span the random model is
    uniform; an empty table gives no rows; only doc_id and text are read."""
    own = secret_spans(docs).groupBy("did", "th").agg(
        F.sort_array(F.collect_set(F.struct("start", "rank", "end"))).alias("all"))
    own = own.withColumn("base", F.filter("all", lambda s: s.rank < 3)).select(
        F.col("did").alias("_did"), F.col("th").alias("_th"), "base", F.filter("all", lambda s: (s.rank < 3) | ~F.exists(
            "base", lambda b: (b.start < s.end) & (s.start < b.end))).alias("all"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    out = row_keys(docs).select("doc_id", "_did", "_th").join(own, ["_did", "_th"], "left")
    base, every = F.coalesce("base", none), F.coalesce("all", none)
    counts = [_count(every, r).alias(f"n_{k}") for r, k in enumerate(KINDS)]
    return out.select("doc_id", *counts, F.sha2(_text(base), 256).alias("base_sha256"), _text(every).alias("spans"))
