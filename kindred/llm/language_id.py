"""Language ID by interpolated Kneser-Ney character language models.

Four-gram counts per language are gathered from all training documents (numpy
per batch, summed by Spark).  The lower orders are continuation counts.  Models
are sorted arrays of packed n-grams (four 16-bit units: exact, no collisions)
searched by bisection, with one column a language.  All n-grams stay: discounts and
continuation counts come from the full tables in Spark, and a model over
MAX_CELLS is scored piece by piece, one pass over the texts for each.  A text is assigned to the
language with the lowest cross-entropy per character; a temperature fitted on all
training texts turns the entropies into a probability, and a text whose best
entropy lies far beyond all of theirs is rejected.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import materialise, row_keys, shipped

UND = "und"
ORDER = 4
#: About the size of a broadcast piece of the model: n-grams times languages (32 MB of floats).
MAX_CELLS = 8_000_000
#: Temperatures among which the likelihood of the training rows chooses.
TEMPERATURES = (0.05, 0.1, 0.2, 0.4, 0.8, 1.6, 3.2, 6.4)
SLACK, SURE_LETTERS = 1.5, 60
_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which 16-bit units are letters; halves of surrogate pairs are none by themselves."""
    if not _LETTER:
        _LETTER.append(np.array([not 0xD800 <= i < 0xE000 and chr(i).isalpha() for i in range(1 << 16)]))
    return _LETTER[0]


def letters(units: np.ndarray) -> np.ndarray:
    """Which units belong to letters; a surrogate pair is judged as the character it is."""
    out = letter_table()[units]
    high = np.flatnonzero((units[:-1] & 0xFC00 == 0xD800) & (units[1:] & 0xFC00 == 0xDC00))
    if len(high):
        points = 0x10000 + ((units[high].astype(np.int64) - 0xD800) << 10) + (units[high + 1].astype(np.int64) - 0xDC00)
        known, at = np.unique(points, return_inverse=True)
        out[high] = out[high + 1] = np.array([chr(c).isalpha() for c in known.tolist()])[at]
    return out


def grams(text: str) -> np.ndarray:
    """Packed four-grams of the lower-cased text; runs of anything but letters
    count as one space, and one space stands at either end."""
    units = np.frombuffer(text.lower().encode("utf-16-le", "surrogatepass"), dtype="<u2")
    is_letter = letters(units)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first unit after a run of letters stands for the space
    units = np.where(is_letter, units, 32)[keep].astype(np.uint64)
    if not is_letter.any():
        return np.zeros(0, dtype=np.uint64)
    pad = [32] * (1 if units[-1] == 32 else 2)
    units = np.concatenate((np.array([32, 32], dtype=np.uint64), units, np.array(pad[:-1], dtype=np.uint64)))
    if len(units) < ORDER:
        units = np.concatenate((units, np.full(ORDER - len(units), 32, dtype=np.uint64)))
    return (units[:-3] << np.uint64(48)) | (units[1:-2] << np.uint64(32)) | (units[2:-1] << np.uint64(16)) | units[3:]


def held_out(mod: int, rest: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("doc_id").isNotNull() & ~held_out(5, 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def _merge(parts):
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts, at)


def _count(batches):
    import pyarrow as pa

    raw: dict[str, list] = {}
    size: dict[str, int] = {}
    done: dict[str, list] = {}

    def fold(lang):
        keys, counts = np.unique(np.concatenate(raw.pop(lang)), return_counts=True)
        size[lang] = 0
        done[lang] = [_merge([*done.get(lang, []), (keys, counts)])]

    def out(lang):
        keys, counts = done.pop(lang)[0]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])

    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            g = grams(text)
            if len(g):
                raw.setdefault(lang, []).append(g)
                size[lang] = size.get(lang, 0) + len(g)
                if size[lang] > 1_000_000:
                    fold(lang)
                    if len(done[lang][0][0]) > 1_000_000:
                        yield out(lang)
    for lang in list(raw):
        fold(lang)
    for lang in list(done):
        yield out(lang)


class Model:
    """Kneser-Ney models of all languages over shared sorted n-gram arrays: of all
    four-grams in ``table``, or of one piece with its ``levels`` (order -> n-grams
    with counts), ``discounts`` and ``uniform`` from the full tables."""

    def __init__(self, table: pd.DataFrame | None, langs=None, levels=None, discounts=None, uniform=None):
        if levels is None:
            levels = {ORDER: table}
            for n in range(ORDER - 1, 0, -1):
                t = levels[n + 1][["lang"]].assign(gram=levels[n + 1]["gram"] & ((1 << 16 * n) - 1))
                levels[n] = t.groupby(["lang", "gram"]).size().reset_index(name="n")
            discounts = {(n, l): discount((g["n"] == 1).sum(), (g["n"] == 2).sum()) for n, t in levels.items() for l, g in t.groupby("lang")}
        self.langs = sorted(table["lang"].unique()) if langs is None else langs
        self.orders = [self._order(n, levels[n], discounts) for n in range(1, ORDER + 1)]
        self.uniform = uniform or 1 / (len(self.orders[0]["keys"]) + 1)
        self.keys = self.orders[-1]["keys"]
        self.table = self.log_p(self.keys).astype(np.float32)

    def _order(self, n, table, discounts):
        level = {l: (g["gram"].to_numpy(dtype=np.int64).view(np.uint64), g["n"].to_numpy(dtype=float)) for l, g in table.groupby("lang")}
        none = np.zeros(0, dtype=np.uint64)
        keys = np.unique(np.concatenate([none, *(k for k, _ in level.values())]))
        ctx = np.unique(keys >> np.uint64(16))
        num = np.zeros((len(keys), len(self.langs)))
        back = np.ones((len(ctx), len(self.langs)))
        for j, lang in enumerate(self.langs):
            if lang not in level:
                continue
            k, c = level[lang]
            d = discounts[n, lang]
            own, at = np.unique(k >> np.uint64(16), return_inverse=True)
            total, types = np.bincount(at, weights=c), np.bincount(at)
            num[np.searchsorted(keys, k), j] = np.maximum(c - d, 0) / total[at]
            back[np.searchsorted(ctx, own), j] = d * types / total
        return {"keys": keys, "ctx": ctx, "num": num, "back": back}

    def log_p(self, grams4: np.ndarray) -> np.ndarray:
        """ln P(last character | the three before) per language."""
        p = np.full((len(grams4), len(self.langs)), self.uniform)
        for n, o in enumerate(self.orders, 1):
            key = grams4 & np.uint64((1 << (16 * n)) - 1)
            p = _rows(o["ctx"], o["back"], key >> np.uint64(16), 1.0) * p + _rows(o["keys"], o["num"], key, 0.0)
        return np.log(p)

    def sums(self, text: str | None, piece: int = 0, plan=None) -> np.ndarray:
        """Number of the text's four-grams that fall into the piece, and the sum of
        their ln P per language."""
        g, c = np.unique(grams(text) if text else np.zeros(0, dtype=np.uint64), return_counts=True)
        if plan is not None:
            own = piece_of(g, *plan) == piece
            g, c = g[own], c[own]
        if not len(g):
            return np.zeros(len(self.langs) + 1)
        found = np.zeros(len(g), dtype=bool)
        total = np.zeros(len(self.langs))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
            found = self.keys[at] == g
            total = c[found] @ self.table[at[found]]
        if not found.all():
            total = total + c[~found] @ self.log_p(g[~found])
        return np.concatenate(([c.sum()], total))


class Judge:
    """From the sums of a text to its language."""

    def __init__(self, langs):
        self.langs, self.tau, self.limit = langs, 1.0, {}

    @staticmethod
    def entropies(parts) -> tuple[np.ndarray | None, int]:
        total = np.sum([np.asarray(p) for p in parts], axis=0)
        return (-total[1:] / total[0], int(total[0])) if total[0] else (None, 0)

    def posterior(self, h: np.ndarray, n: int) -> np.ndarray:
        z = -self.tau * np.sqrt(n) * (h - h.min())
        e = np.exp(z)
        return e / e.sum()

    def losses(self, parts, lang) -> tuple[list[int], int, float] | None:
        """Loss of a labelled text at every temperature, in millionths so that sums do not
        depend on their order; its number of four-grams; its entropy in its language."""
        h, n = self.entropies(parts)
        if h is None or lang not in self.langs:
            return None
        j = self.langs.index(lang)
        z = -np.array(TEMPERATURES)[:, None] * np.sqrt(n) * (h - h.min())
        p = np.exp(z[:, j]) / np.exp(z).sum(axis=1)
        return np.round(-1e6 * np.log(np.maximum(p, 1e-9))).astype(np.int64).tolist(), n, float(h[j])

    def calibrate(self, rows: DataFrame):
        """Temperature by likelihood; per language the largest entropy seen: of all
        ``rows(_parts, lang)``, summed by Spark."""
        judge = Judge(self.langs)

        @F.pandas_udf("loss array<long>, n long, h double")
        def judged(parts: pd.Series, lang: pd.Series) -> pd.DataFrame:
            found = [judge.losses(p, l) or (None, None, None) for p, l in zip(parts, lang)]
            return pd.DataFrame(found, columns=["loss", "n", "h"]).astype({"n": "Int64", "h": "float64"})

        seen = rows.select("lang", judged("_parts", "lang").alias("j")).filter("j.n is not null")
        sums = [F.sum(F.col("j.loss")[i]).alias(f"t{i}") for i in range(len(TEMPERATURES))]
        limit = F.max(F.when(F.col("j.n") >= SURE_LETTERS, F.col("j.h"))).alias("limit")
        langs = seen.groupBy("lang").agg(*sums, limit).collect()       # one row a language
        loss = [sum(r[f"t{i}"] for r in langs) for i in range(len(TEMPERATURES))]
        self.tau = TEMPERATURES[loss.index(min(loss))] if langs else TEMPERATURES[0]
        self.limit = {self.langs.index(r.lang): r.limit for r in langs if r.limit is not None}

    def predict(self, parts) -> tuple[str, float, float | None, bool]:
        """(language, probability, cross-entropy, rejected)."""
        h, n = self.entropies(parts)
        if h is None:
            return UND, 0.0, None, True
        j = int(np.argmin(h))
        return self.langs[j], float(self.posterior(h, n)[j]), float(h[j]), bool(
            n >= SURE_LETTERS and h[j] > SLACK * self.limit.get(j, np.inf))


def _rows(keys, values, wanted, missing):
    if not len(keys):
        return np.full((len(wanted), values.shape[1]), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], missing)


def discount(n1, n2) -> float:
    return min(0.95, max(0.1, n1 / (n1 + 2 * n2))) if n1 else 0.5


def piece_of(g: np.ndarray, first: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Piece of every four-gram, by its third character and, where that has several pieces, its second."""
    third = (g >> np.uint64(16)) & np.uint64(0xFFFF)
    return first[third] + ((g >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64) % parts[third]


def plan_pieces(sizes: list[tuple[int, int]], limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first piece, number of pieces) of every third character, and how many
    pieces there are: neighbours share a piece of about ``limit`` four-grams."""
    first, parts = np.zeros(1 << 16, dtype=np.int64), np.ones(1 << 16, dtype=np.int64)
    at, filled = 0, 0
    for char, n in sorted(sizes):
        if filled and filled + n > limit:
            at, filled = at + 1, 0
        first[char], parts[char] = at, max(1, -(-n // limit))
        if parts[char] > 1:
            at, filled = at + int(parts[char]), 0
        else:
            filled += n
    return first, parts, at + (filled > 0)


class Fitted:
    """Full n-gram tables in Spark, cut into pieces of bounded size for scoring."""

    def __init__(self, counts: DataFrame, langs: list[str]):
        self.langs, self.levels = langs, {ORDER: counts}
        for n in range(ORDER - 1, 0, -1):
            suffix = F.col("gram").bitwiseAND(F.lit((1 << 16 * n) - 1)).alias("gram")
            self.levels[n] = materialise(self.levels[n + 1].groupBy("lang", suffix).agg(F.count(F.lit(1)).alias("n")), "grams")
        self.discounts = {}
        for n, t in self.levels.items():
            for r in t.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).collect():
                self.discounts[n, r.lang] = discount(r.n1, r.n2)
        self.uniform = 1 / (self.levels[1].select("gram").distinct().count() + 1)
        sizes = counts.select("gram").distinct().groupBy(self._char(16).alias("c")).count().collect()  # 65,536 rows at most
        *self.plan, self.pieces = plan_pieces([(r.c, r["count"]) for r in sizes], max(1, MAX_CELLS // len(langs)))
        self.models: dict[int, object] = {}

    @staticmethod
    def _char(shift: int) -> Column:
        return F.shiftrightunsigned("gram", shift).bitwiseAND(F.lit(0xFFFF))

    def model(self, piece: int) -> Model:
        first, parts = self.plan
        chars = [(int(c), int(parts[c]), piece - int(first[c])) for c in np.flatnonzero((first <= piece) & (piece < first + parts))]
        spark = self.levels[1].sparkSession
        own = F.broadcast(spark.createDataFrame(chars, "c long, k long, r long"))  # 65,536 rows at most

        def rows(n):
            t = self.levels[n]
            if n == 1 or self.pieces == 1:
                return t.toPandas()
            t = t.withColumn("c", self._char(16)).join(own, "c")
            return (t if n == 2 else t.filter(self._char(32) % F.col("k") == F.col("r"))).select("lang", "gram", "n").toPandas()

        return Model(None, self.langs, {n: rows(n) for n in self.levels}, self.discounts, self.uniform)

    def sums(self, piece: int):
        """UDF text -> sums over the four-grams of the piece, and what it broadcasts."""
        model, shared = self.models.get(piece) or shipped(self.levels[1].sparkSession, self.model(piece))
        if self.pieces == 1:
            self.models[piece] = model, shared
        plan = tuple(self.plan) if self.pieces > 1 else None

        @F.pandas_udf("array<double>")
        def run(text: pd.Series) -> pd.Series:
            return pd.Series([model().sums(t, piece, plan) for t in text])

        return run, shared

    def with_sums(self, docs: DataFrame) -> DataFrame:
        """``docs`` with ``_parts``, the sums of every piece.  A model of several
        pieces takes one pass over the texts for each of them."""
        if self.pieces == 1:
            return docs.withColumn("_parts", F.array(self.sums(0)[0]("text")))
        keyed, passes = row_keys(docs), []
        for piece in range(self.pieces):
            udf, shared = self.sums(piece)
            rows = keyed.select("_did", "_th", F.lit(piece).alias("piece"), udf("text").alias("s"))
            passes.append(materialise(rows.dropDuplicates(["_did", "_th"]), "sums"))
            shared.unpersist()
        parts = reduce(DataFrame.unionByName, passes).groupBy("_did", "_th").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("piece", "s"))), lambda x: x["s"]).alias("_parts"))
        return keyed.join(parts, ["_did", "_th"]).drop("_did", "_th")


def fit(docs: DataFrame, columns: list[str]) -> tuple[Judge, DataFrame] | None:
    """The judge fitted on all training rows, and ``columns`` of ``docs`` with ``_parts`` by
    models of all languages; None without training rows.  Texts are scored once: calibration
    and prediction read the written sums."""
    rows = training_rows(docs)
    counts = rows.select("text", "lang").mapInArrow(_count, "lang string, gram long, n long")
    counts = materialise(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    labelled = F.col("doc_id").isNotNull() & ~held_out(5, 0) & F.col("text").isNotNull()
    scored = Fitted(counts, langs).with_sums(docs).withColumn("_label", F.when(labelled, F.col("lang")))
    scored = materialise(scored.select(*columns, "_parts", "_label"), "scored")
    judge = Judge(langs)
    judge.calibrate(scored.filter("_label is not null").select("_parts", F.col("_label").alias("lang")))
    return judge, scored.drop("_label")


def predicted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``_p``, struct(lang_pred, score, entropy, rejected) by models fitted on ``docs``."""
    kind = "lang_pred string, score double, entropy double, rejected boolean"
    found = fit(docs, columns)
    if found is None:
        return docs.select(*columns).withColumn("_p", F.struct(F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"),
                                              F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("rejected")))
    judge, scored = found

    @F.pandas_udf(kind)
    def predict(parts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge.predict(p) for p in parts], columns=["lang_pred", "score", "entropy", "rejected"])

    return scored.withColumn("_p", predict("_parts")).drop("_parts")


def identify(docs: DataFrame) -> DataFrame:
    """``documents`` -> one row each: doc_id, held_out, lang_pred, score, entropy,
    rejected.

    Null texts and texts without a letter are ``und`` with score 0 and rejected;
    texts of fewer than 60 letters are never rejected; ties go to the language
    that sorts first; repeated rows get the same answer and count twice in
    training; without labelled training rows all texts are ``und``.  Only
    doc_id, text and lang are read, lang for training alone."""
    return predicted(docs.select("doc_id", "text", "lang"), ["doc_id"]).select("doc_id", held_out(5, 0).alias("held_out"), "_p.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language is rejected."""
    return predicted(docs, docs.columns).filter(~F.col("_p.rejected")).select(*docs.columns)
