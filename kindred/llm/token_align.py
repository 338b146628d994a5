"""Cross-tokenizer alignment: where the token borders of two tokenizers agree.

Each text is encoded twice.  The cumulative byte ends of either token list become a
dictionary end -> index; the intersection of their key sets, sorted, gives the common
ends, and consecutive common ends slice both id lists into groups.  Inside a slice
every pair of tokens with overlapping bytes is a link.

A space between two other characters starts a token in both tokenizers (their files are
asked whether that holds), so it is a common end, and what lies between two of them is
encoded, aligned and linked once per worker however often it comes; many such pieces
are encoded as one text, which is cut again at their ends.

Links are counted by documents over the whole corpus.  Documents are packed into
blocks of bounded text; a block writes its distinct id pairs once, with the number of
its documents that hold each, and its documents refer to them by position.  So the
shuffles carry one row per block and pair (a pair found in every document is one row a
block, no hot key), the counts return to the blocks by the block's key, and documents
are scored against their block's list only.  No table of pairs is broadcast.

Defined results: null and empty texts, and texts whose token bytes are not
space + text in both tokenizers, have no tokens, groups or links and an empty
``groups``; every row, repeated or with a null id, gets its own result; only the id
and text columns are read, so other columns of any name do no harm; an empty table
gives an empty one.
"""

from __future__ import annotations

import itertools
import json
import re
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm.bpe import byte_letters, file_bytes, kept_by_worker, list_column, runs
from kindred.llm.common import materialise

#: Code points of text in one block (one document at least); bounds a task's memory.
BLOCK = 2_000_000
#: Distinct pieces of text that a worker remembers beside those of its last block; bounds memory, not results.
CACHE = 250_000
#: Code points of pieces encoded as one text.
JOINED = 50_000
SPACE = "▁"
#: A space between two characters that are no white space; the space comes first, so that it is searched for.
CUT = re.compile(r" (?<=\S )(?=\S)")
DOC, PAIRS = 0, 1
SCHEMA = ("block long, role int, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
          "groups string, refs array<int>, times array<int>")


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index after the last token of each group in both token lists."""
    at_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    return (np.fromiter(map(at_a.__getitem__, common), np.int64, len(common)),
            np.fromiter(map(at_b.__getitem__, common), np.int64, len(common)))


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token indices of all overlapping pairs, for all slices at once.

    Inside a slice of x and y tokens no ends agree, so its x + y - 1 distinct ends
    each close one link, the one of the two tokens that cover the byte before."""
    closing = np.concatenate((ends_a, ends_b))
    closing.sort(kind="stable")          # two sorted runs, which are merged
    closing = closing[np.append(closing[:-1] != closing[1:], True)] if len(closing) else closing
    return np.searchsorted(ends_a, closing), np.searchsorted(ends_b, closing)


def group_order(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
    """``4 * id + mark`` of both lists in the order of the groups, a group's A ids before
    its B ids; the mark says what follows: 1 an id of the same list, 2 the B ids of the
    group, 3 the next group."""
    def marks(n, cut, last):
        out = np.ones(n, dtype=np.int64)
        out[cut - 1] = last
        return out

    of_a = np.repeat(np.arange(len(cut_a)), np.diff(cut_a, prepend=0))
    of_b = np.repeat(np.arange(len(cut_b)), np.diff(cut_b, prepend=0))
    out = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    # a group's A ids stand behind all B ids of the groups before, its B ids behind its A ids
    out[np.arange(len(ids_a)) + np.concatenate(([0], cut_b))[of_a]] = 4 * ids_a + marks(len(ids_a), cut_a, 2)
    out[np.arange(len(ids_b)) + cut_a[of_b]] = 4 * ids_b + marks(len(ids_b), cut_b, 3)
    return out


class Tokenizers:
    """Tokenizer A (byte-level BPE) and B (pieces with byte fallback) with the bytes of every id."""

    def __init__(self, spec_a: bytes, spec_b: bytes):
        import os

        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(spec_a.decode())
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=spec_b)
        letters = byte_letters()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for s, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in s) if all(c in letters for c in s) else s.encode()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.written = [f"{i}{mark}" for i in range(max(len(self.bytes_a), len(self.bytes_b))) for mark in ("", ",", "|", ";")]
        self.width = np.array([len(x) for x in self.written], dtype=np.int64)
        self.size_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)

        pre = json.loads(spec_a)["pre_tokenizer"] or {}
        plain = json.loads(spec_a)["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.cuts = bool(plain) and all(SPACE not in p[1:] or set(p) == {SPACE} for p in pieces)
        self.forget()

    def forget(self) -> None:
        """Known pieces: their number, and by number ids, groups, links and counts."""
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.links: list[bytes] = []
        self.fresh: list[np.ndarray] = []
        self.counts = np.zeros((0, 5), dtype=np.int64)   # A ids, B ids, groups, links, whether the bytes are the text's

    def keep(self, pieces: list[str]) -> None:
        at = [self.number[p] for p in pieces]
        self.groups, self.links = [self.groups[i] for i in at], [self.links[i] for i in at]
        self.counts, self.number = self.counts[at], dict(zip(pieces, range(len(at))))

    def pieces(self, text: str) -> list[str]:
        """Space + text, cut where both tokenizers end a token."""
        return list(map(" ".__add__, CUT.split(text) if self.cuts else [text]))

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int], bool]]:
        """Ids of texts that begin with a space in both tokenizers, and whether their bytes are the text's."""
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        out = []
        for t, x, y in zip(texts, a, b):
            whole = t.encode()
            out.append((x, y, b"".join(map(self.bytes_a.__getitem__, x)) == whole and b"".join(map(self.bytes_b.__getitem__, y)) == whole))
        return out

    def learn(self, new: list[str]) -> None:
        """Encode pieces that were not met before, and align them all in one row.

        Pieces between which ``CUT`` would cut again (one space in front and no other white
        space at either end) are encoded as one text; where its bytes differ it is taken
        apart until the pieces at fault are found."""
        plain, alone = [], []
        for p in new:
            (plain if self.cuts and len(p.strip()) == len(p) - 1 else alone).append(p)
        parts = [plain[lo:hi] for lo, hi in runs([len(p) for p in plain], JOINED)] + [[p] for p in alone]
        held, a, b, wrong = [], [], [], []         # pieces whose bytes are the text's, and their ids
        while parts:
            again: list[list[str]] = []
            for own, (x, y, fine) in zip(parts, self.encode(["".join(own) for own in parts])):
                if fine:
                    held += own
                    a.append(x)
                    b.append(y)
                elif len(own) == 1:
                    wrong += own
                else:
                    again += map(list, itertools.batched(own, -(-len(own) // 16)))
            parts = again
        ia, ib = (np.fromiter(chain.from_iterable(x), np.int64, sum(map(len, x))) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.size_a[ia]), np.cumsum(self.size_b[ib])
        letters = np.frombuffer("".join(held).encode("utf-32-le"), dtype="<u4")
        sizes = np.cumsum(1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF), dtype=np.int64)
        stop = sizes[np.cumsum(np.fromiter(map(len, held), np.int64, len(held))) - 1]     # last byte of each piece
        n_a, n_b = (np.diff(np.searchsorted(ends, stop, side="right"), prepend=0) for ends in (ends_a, ends_b))
        cut_a, cut_b = align(ends_a, ends_b)
        la, lb = links(ends_a, ends_b)
        groups = np.diff(np.searchsorted(ends_a[cut_a - 1], stop, side="right"), prepend=0)
        closing = np.maximum(ends_a[la] - self.size_a[ia[la]], ends_b[lb] - self.size_b[ib[lb]])  # first byte of a link
        linked = np.diff(np.searchsorted(closing, stop), prepend=0)
        order = group_order(ia, ib, cut_a, cut_b)
        text = "".join(map(self.written.__getitem__, order.tolist()))
        at = np.concatenate(([0], np.cumsum(self.width[order])))[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        self.groups += [text[x:y] for x, y in itertools.pairwise(at)] + [""] * len(wrong)
        data, at = (ia[la] << 32 | ib[lb]).tobytes(), np.concatenate(([0], 8 * np.cumsum(linked))).tolist()
        self.links += [data[x:y] for x, y in itertools.pairwise(at)] + [b""] * len(wrong)
        self.number.update(zip(held + wrong, range(len(self.number), len(self.number) + len(new))))
        self.fresh += [np.stack((n_a, n_b, groups, linked, np.ones_like(n_a)), axis=1), np.zeros((len(wrong), 5), dtype=np.int64)]

    def align(self, texts: list[str]):
        """Per text its counts (A ids, B ids, groups, links), groups and link keys."""
        docs = [self.pieces(t) if t else [] for t in texts]
        used = set().union(*docs)
        if len(self.number) > CACHE:     # what these texts use is likely to come again
            self.keep([p for p in used if p in self.number])
        new = [p for p in used if p not in self.number]
        for lo, hi in runs([len(p) for p in new], 100_000):
            self.learn(new[lo:hi])
        self.counts, self.fresh = np.concatenate((self.counts, *self.fresh)), []
        for own in docs:
            at = np.fromiter(map(self.number.__getitem__, own), np.int64, len(own))
            counts = self.counts[at]
            if not len(at) or not counts[:, 4].all():
                yield (0, 0, 0, 0), "", np.empty(0, np.int64)
                continue
            at = at.tolist()
            yield (tuple(counts[:, :4].sum(axis=0).tolist()), "".join(map(self.groups.__getitem__, at))[:-1],
                   np.frombuffer(b"".join(map(self.links.__getitem__, at)), dtype=np.int64))


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of ``SCHEMA``: one per document (role DOC) with its groups, the positions of
    its distinct links in the block's list and how often each occurs; and one per
    block (role PAIRS) with the list (``pairs``, sorted) and in ``times`` the number
    of its documents that hold each."""
    a, b = file_bytes(docs, path_a), file_bytes(docs, path_b)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        both = kept_by_worker((a.value, b.value), Tokenizers)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in runs([len(t or "") for t in texts], BLOCK):
                yield _block(both, block, ids.slice(lo, hi - lo), [t or "" for t in texts[lo:hi]], pa)
                block += 1

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA + ", pairs array<long>")


def _block(both: Tokenizers, block: int, doc_ids, texts: list[str], pa):
    counts, groups, keys = zip(*both.align(texts))
    groups = list(groups)
    # one sort by pair; documents stay in order inside each pair
    flat, sizes = np.concatenate(keys), [len(k) for k in keys]
    doc = np.repeat(np.arange(len(texts)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, doc = flat[order], doc[order]
    new_pair = np.ones(len(flat), dtype=bool)
    new_pair[1:] = flat[1:] != flat[:-1]
    new_doc = new_pair.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new_doc)                       # one place per (pair, document)
    pairs, of_pair = flat[new_pair], (np.cumsum(new_pair) - 1)[at]
    held = np.bincount(of_pair, minlength=len(pairs))
    times, doc = np.diff(np.append(at, len(flat))), doc[at]
    by_doc = np.argsort(doc, kind="stable")
    cuts = np.cumsum(np.bincount(doc, minlength=len(texts)))[:-1]
    refs, times = np.split(of_pair[by_doc], cuts), np.split(times[by_doc], cuts)
    n, none = len(texts), np.empty(0, dtype=np.int32)
    columns = [pa.array(np.full(n + 1, block)), pa.array([DOC] * n + [PAIRS], type=pa.int32()),
               pa.array(np.arange(n + 1), type=pa.int32()), pa.concat_arrays([doc_ids.cast(pa.int64()), pa.nulls(1, pa.int64())])]
    columns += [pa.array([c[k] for c in counts] + [None], type=pa.int64()) for k in range(4)]
    columns += [pa.array(groups + [None], type=pa.string()), list_column([*refs, none], pa.int32()),
                list_column([*times, held], pa.int32()), list_column([none] * n + [pairs], pa.int64())]
    names = [c.split()[0] for c in SCHEMA.split(", ")] + ["pairs"]
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], names=names)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``(pair, count, best)``: documents that hold each linked id pair, and whether no
    pair of its A id has more.  An A id has at most as many pairs as B has ids, so
    the window's groups are bounded by the vocabulary."""
    counts = (rows.filter(F.col("role") == PAIRS)
              .select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
              .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count")))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def link_scores(rows: DataFrame) -> DataFrame:
    """Per document of :func:`aligned`: all its columns, ``n_best`` and ``count_sum``.
    Blocks meet the counts of their own pairs; both sides of such a group are
    bounded by the block."""
    asked = rows.filter(F.col("role") == PAIRS).select(F.col("block").alias("of"), F.posexplode("pairs").alias("at", "pair"))
    found = asked.join(pair_counts(rows), "pair").select("of", "at", "count", "best")
    docs = rows.filter(F.col("role") == DOC).select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "refs", "times")
    keep = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def score(left, right):
        import pyarrow as pa

        at = np.asarray(right.column("at"))
        count, top = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        count[at] = np.asarray(right.column("count"))
        top[at] = np.asarray(right.column("best").cast(pa.int64()))
        best, total = [], []
        for refs, times in zip(left.column("refs"), left.column("times")):
            refs, times = np.asarray(refs.values), np.asarray(times.values).astype(np.int64)
            best.append(int((times * top[refs]).sum()) if len(refs) else 0)
            total.append(int((times * count[refs]).sum()) if len(refs) else 0)
        return left.select(keep).append_column("n_best", pa.array(best, type=pa.int64())).append_column(
            "count_sum", pa.array(total, type=pa.int64()))

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", n_best long, count_sum long"
    return docs.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(score, schema)


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum of every document."""
    return link_scores(materialise(aligned(docs, path_a, path_b), "aligned"))


def digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The same with the SHA-256 of the groups in place of their text, which is several
    times the document and so never written."""
    groups = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.encode("groups", "UTF-8"), 256))
    rows = materialise(aligned(docs, path_a, path_b).withColumn("groups", groups), "aligned")
    return link_scores(rows).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
