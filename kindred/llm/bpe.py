"""BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of every distinct word of a batch.  A
proposal is the BPE encoding exactly when no merge of the word crosses one of its
token borders, and whether one does depends only on the two tokens at the border:
the left token offers its right spine (the pieces that end at the border, each
alive until the merge that consumes it), the right token its left spine.  All
adjacent pairs of a batch are tested at once with numpy; only words with a failing
pair are merged exactly, in rank order.

Normalising, splitting into words and the strings of special tokens follow the
tokenizer file through the ``tokenizers`` library; the merging is done here.  Work
is row by row: no shuffle, bounded memory beside the text itself, and a lost
executor costs its tasks.

Defined results: null and empty texts have no tokens and decode to the empty
string; every row gets its own result, repeated rows alike; columns are expressions,
so other columns of any name pass through; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Distinct chunks that a task remembers beside those of its last texts; bounds memory, not results.
CACHE = 250_000
#: Words up to so many letters are handled many at a time with numpy, longer ones one by one; the result is the same.
SHORT = 64
#: Words that numpy handles at a time.
WORDS = 20_000
#: Marks the last letter of a word where the vocabulary has an end-of-word suffix; letters are below it.
LAST = 1 << 21
#: Beyond every merge rank: the piece is never consumed.
NEVER = 1 << 40


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merges:
    """Merge table of a BPE model: ranks of id pairs and the two spines of every token."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.ids, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        n = max(self.ids.values()) + 1
        left = np.array([self.ids[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([self.ids[b] for _, b in pairs], dtype=np.int64)
        made = np.array([self.ids[a + b] for a, b in pairs], dtype=np.int64)
        rank = np.arange(len(pairs), dtype=np.int64)
        self.rank = {(a, b): (r, m) for a, b, r, m in zip(left.tolist(), right.tolist(), rank.tolist(), made.tolist())}
        order = np.argsort(left << 32 | right, kind="stable")
        self.keys, self.key_rank = (left << 32 | right)[order], rank[order]
        # the merge that makes each token; bases have none
        self.left, self.right, self.born = (np.full(n, -1, dtype=np.int64) for _ in range(3))
        for t, v in ((self.left, left), (self.right, right), (self.born, rank)):
            t[made[::-1]] = v[::-1]
        self.trusted = self._trusted(left, right, made, rank)
        self.made = made
        self._plant()

    def symbols(self, text: str) -> list[int]:
        """Letters of a token; the last one is marked if the token ends a word."""
        if self.end and text.endswith(self.end) and len(text) > len(self.end):
            own = [ord(c) for c in text[:-len(self.end)]]
            return [*own[:-1], own[-1] | LAST]
        return [ord(c) for c in text]

    def _plant(self) -> None:
        """Tree of the trusted tokens: ``key`` (node, letter) sorted, the node it leads
        to, and the token that a node completes (-1: none)."""
        children: dict[tuple[int, int], int] = {}
        token = [-1]
        self.letter = {}
        for text, i in self.ids.items():
            own = self.symbols(text)
            if len(own) == 1:
                self.letter[own[0]] = i
            if not self.trusted[i]:
                continue
            node = 0
            for c in own:
                child = children.get((node, c))
                if child is None:
                    child = children[node, c] = len(token)
                    token.append(-1)
                node = child
            token[node] = i
        self.children, self.token = children, np.array(token, dtype=np.int64)
        edge = np.array([n << 22 | c for n, c in children], dtype=np.int64)
        order = np.argsort(edge)
        self.edges, self.leads = edge[order], np.fromiter(children.values(), np.int64, len(children))[order]
        known = np.array(sorted(self.letter), dtype=np.int64)
        self.known_letters, self.letter_ids = known, np.array([self.letter[c] for c in known.tolist()], dtype=np.int64)

    def _trusted(self, left, right, made, rank) -> np.ndarray:
        """Tokens whose own encoding is the token, found by the pair test on their
        two halves.  The test needs every merge to come after those of its parts; a
        token made otherwise, or twice, is never proposed."""
        ok = np.ones(len(self.born), dtype=bool)
        sound = (rank > self.born[left]) & (rank > self.born[right]) & (self.born[made] == rank)
        self.sound = bool(sound.all())
        ok[made] = sound & (self.first_crossing(left, right) == rank)
        while True:
            new = ok.copy()
            new[made] &= ok[left] & ok[right]
            if (new == ok).all():
                return ok
            ok = new

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of id pairs, NEVER where there is none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_rank[at], NEVER)

    def _spine(self, tokens: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces at one end of each token from the base letter up (columns), padded
        with the token, and when each is consumed."""
        steps, t = [tokens], tokens
        while (side[t] >= 0).any():
            t = np.where(side[t] >= 0, side[t], t)
            steps.append(t)
        pieces = np.stack(steps[::-1], axis=1)
        gone = np.full(pieces.shape, NEVER)
        gone[:, :-1] = np.where(pieces[:, 1:] != pieces[:, :-1], self.born[pieces[:, 1:]], -1)
        return pieces, gone

    def first_crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the first merge across the border of each pair of tokens, NEVER
        where none happens.  Both ends grow in rank order, the left one first on
        ties; a merge across happens while both of its pieces are alive."""
        (x, gx), (y, gy) = self._spine(a, self.right), self._spine(b, self.left)
        i, j, row = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64), np.arange(len(a))
        found = np.full(len(a), NEVER)
        for _ in range(x.shape[1] + y.shape[1]):
            cx, cy = gx[row, i], gy[row, j]
            r = self.ranks(x[row, i], y[row, j])
            hit = (found == NEVER) & (r < cx) & (r <= cy)
            found[hit] = r[hit]
            left = cx <= cy
            i = np.minimum(i + left, x.shape[1] - 1)
            j = np.minimum(j + ~left, y.shape[1] - 1)
        return found

    def _flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of all words in a row, last ones marked, and where each word ends."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        ends = np.cumsum(sizes)
        if self.end:
            letters[ends[sizes > 0] - 1] |= LAST
        return letters, ends

    def speculate(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match over trusted tokens, all words a letter at a time:
        word and token of every match, in order.  A word with an unknown letter has
        no match."""
        letters, ends = self._flat(words)
        letters = np.append(letters, -1)
        at = ends - np.fromiter(map(len, words), np.int64, len(words))   # next letter
        word = np.flatnonzero(at < ends)
        at, end = at[word], ends[word]
        node, best, best_end = np.zeros(len(word), np.int64), np.full(len(word), -1), at.copy()
        owners, tokens, failed = [], [], []
        while len(word):
            key = node << 22 | np.where(at < end, letters[at], (1 << 22) - 1)
            k = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            on = self.edges[k] == key
            node = np.where(on, self.leads[k], node)
            at = at + on
            done = self.token[node]
            hit = on & (done >= 0)
            best, best_end = np.where(hit, done, best), np.where(hit, at, best_end)
            if on.all():
                continue
            stop = ~on
            failed.append(word[stop & (best < 0)])
            take = stop & (best >= 0)
            owners.append(word[take])
            tokens.append(best[take])
            node, at, best = np.where(stop, 0, node), np.where(stop, best_end, at), np.where(stop, -1, best)
            live = ~(stop & (at >= end)) & ~np.isin(word, failed[-1])
            word, at, end, node, best, best_end = (x[live] for x in (word, at, end, node, best, best_end))
        none = np.empty(0, np.int64)
        owner, token = np.concatenate([none, *owners]), np.concatenate([none, *tokens])
        order = np.argsort(owner, kind="stable")
        owner, token = owner[order], token[order]
        keep = ~np.isin(owner, np.concatenate([none, *failed]))
        return owner[keep], token[keep]

    def merge(self, words: list[str]) -> list[bytes]:
        """Exact merging: lowest rank first, leftmost first.  Unknown letters are dropped."""
        out = [b""] * len(words)
        letters, ends = self._flat(words)
        k = np.minimum(np.searchsorted(self.known_letters, letters), len(self.known_letters) - 1)
        known = self.known_letters[k] == letters
        kept = np.concatenate(([0], np.cumsum(known)))
        ids, stops = self.letter_ids[k[known]], kept[ends]
        starts = np.concatenate(([0], stops[:-1]))
        sizes = stops - starts
        for w in np.flatnonzero(sizes > SHORT).tolist():
            out[w] = np.array(self._merge_long(ids[starts[w]:stops[w]].tolist()), dtype=np.int32).tobytes()
        order = np.flatnonzero((sizes > 0) & (sizes <= SHORT))
        order = order[np.argsort(sizes[order], kind="stable")]
        for s in range(0, len(order), WORDS):
            own = order[s:s + WORDS]
            width = int(sizes[own[-1]])
            at = starts[own][:, None] + np.arange(width)
            inside = np.arange(width) < sizes[own][:, None]
            self._merge_short(np.where(inside, ids[np.where(inside, at, 0)], -1), own, out)
        return out

    def _merge_short(self, part: np.ndarray, own: np.ndarray, out: list) -> None:
        """One row per word, -1 after its end; every pass makes each row's next merge."""
        def ranks(a, b):
            return np.where((a >= 0) & (b >= 0), self.ranks(a, b), NEVER)

        todo = ranks(part[:, :-1], part[:, 1:])
        while len(own):
            low = todo.min(axis=1, initial=NEVER)
            going = low < NEVER
            rest = part[~going]
            for w, ids in zip(own[~going].tolist(), packed(rest[rest >= 0], (rest >= 0).sum(axis=1))):
                out[w] = ids
            part, todo, own, low = part[going], todo[going], own[going], low[going]
            if not len(own):
                return
            row, i = np.arange(len(own)), todo.argmin(axis=1)
            part[row, i] = self.made[low]
            step = np.arange(part.shape[1] - 1)
            part = np.take_along_axis(part, step + (step > i[:, None]), axis=1)
            step = np.arange(todo.shape[1] - 1)
            todo = np.take_along_axis(todo, step + (step >= i[:, None]), axis=1)
            right = i < todo.shape[1]
            todo[row[right], i[right]] = ranks(part[row[right], i[right]], part[row[right], i[right] + 1])
            left = i > 0
            todo[row[left], i[left] - 1] = ranks(part[row[left], i[left] - 1], part[row[left], i[left]])

    def _merge_long(self, part: list[int]) -> list[int]:
        """Exact merging of one word of any length with a heap."""
        n = len(part)
        after, before, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(*r, i, part[i], part[i + 1]) for i in range(n - 1) if (r := self.rank.get((part[i], part[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, new, i, a, b = heapq.heappop(heap)
            k = after[i]
            if not live[i] or k >= n or part[i] != a or part[k] != b:
                continue
            part[i], live[k], after[i] = new, False, after[k]
            if after[i] < n:
                before[after[i]] = i
                if r := self.rank.get((new, part[after[i]])):
                    heapq.heappush(heap, (*r, i, new, part[after[i]]))
            h = before[i]
            if h >= 0 and (r := self.rank.get((part[h], new))):
                heapq.heappush(heap, (*r, h, part[h], new))
        return [t for t, alive in zip(part, live) if alive]

    def encode_words(self, words: list[str]) -> tuple[list[bytes], int]:
        """Ids of each word (int32 in a row), and how many words went to exact merging."""
        if not self.sound:
            return self.merge(words), len(words)
        owner, flat = self.speculate(words)
        sizes = np.bincount(owner, minlength=len(words))
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        key, where = np.unique(flat[inside] << 32 | flat[inside + 1], return_inverse=True)
        bad = np.zeros(len(key), dtype=bool)
        for s in range(0, len(key), 65_536):
            part = key[s:s + 65_536]
            bad[s:s + 65_536] = self.first_crossing(part >> 32, part & 0xFFFFFFFF) != NEVER
        redo = np.union1d(owner[inside[bad[where]]], np.flatnonzero(sizes == 0))
        out = packed(flat, sizes)
        for w, ids in zip(redo.tolist(), self.merge([words[w] for w in redo.tolist()])):
            out[w] = ids
        return out, len(redo)


def packed(flat: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Consecutive runs of ids as int32 bytes."""
    data, stops = flat.astype(np.int32).tobytes(), (4 * np.cumsum(sizes)).tolist()
    return [data[a:b] for a, b in zip([0, *stops], stops)]


class Encoder:
    """Texts -> ids and back for one tokenizer file (its bytes)."""

    def __init__(self, spec: bytes, special: bool = True):
        import pyarrow as pa
        from tokenizers import Tokenizer

        d = json.loads(spec)
        self.merges, self.library = Merges(d), Tokenizer.from_str(spec.decode())
        own = [t for t in d.get("added_tokens", []) if special or not t["special"]]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in own):
            raise ValueError("only plain added tokens are supported")
        self.special = {t["content"]: t["id"] for t in own}
        self.decoder = (d.get("decoder") or {}).get("type")
        if self.decoder not in (None, "ByteLevel"):
            raise ValueError(f"decoder {self.decoder} is not supported")
        strings = {i: s for s, i in self.merges.ids.items()} | {t["id"]: t["content"] for t in d.get("added_tokens", [])}
        letters = byte_letters()
        self.data = {i: bytes(map(letters.__getitem__, s)) if all(c in letters for c in s) else s.encode() for i, s in strings.items()}
        self.table = pa.array([strings.get(i) for i in range(max(strings) + 1)], type=pa.string())
        self.chunks: dict[str, bytes] = {}      # ids as int32 in a row
        self.merged = 0
        # one word whatever its letters, lower-cased: seen on the alphabet itself
        az = "abcdefghijklmnopqrstuvwxyz"
        self.plain = [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.normal(az + az.upper()))] == [az + az]

    def segments(self, text: str):
        """Ordinary runs of a text, and the ids of special tokens between them."""
        if not any(s in text for s in self.special):
            yield text
            return
        import re

        for part in re.split("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")", text):
            if part:
                yield self.special.get(part, part)

    def split(self, text: str) -> list[str]:
        """Runs of a segment between white space.  Python also splits at x1C-x1F, which
        are no white space to the tokenizer; texts with one are normalised whole."""
        if not any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return text.split()
        return [c for c in self.normal(text).split(" ") if c]

    def normal(self, text: str) -> str:
        return self.library.normalizer.normalize_str(text) if self.library.normalizer else text

    def words_of(self, chunks: list[str]) -> list[list[str]]:
        """Words of chunks, as byte-level letters.  Neither normalising nor the split into
        words looks across a space, so many chunks go through the library as one text.
        A chunk of ASCII letters is one word of them, whose bytes stand for themselves."""
        out = [[c.lower()] if self.plain and c.isascii() and c.isalpha() else None for c in chunks]
        if rest := [c for c, ws in zip(chunks, out) if ws is None]:
            found = iter(self._library_words(rest))
            out = [next(found) if ws is None else ws for ws in out]
        return out

    def _library_words(self, chunks: list[str]) -> list[list[str]]:
        plain = self.normal(" ".join(chunks))
        stops = list(itertools.accumulate(len(c) + 1 for c in plain.split(" ")))
        if len(stops) != len(chunks):
            raise ValueError("a chunk changed its number of parts")
        parts: list[list[str]] = [[] for _ in chunks]
        k = 0
        for w, (start, _) in self.library.pre_tokenizer.pre_tokenize_str(plain):
            while start >= stops[k]:
                k += 1
            parts[k].append(w)
        return parts

    def _learn(self, new: list[str]) -> None:
        """Encode chunks that were not met before, over their distinct words."""
        for lo, hi in runs([len(c) for c in new], 500_000):
            part = new[lo:hi]
            words = self.words_of(part)
            fresh = list({w for ws in words for w in ws})
            ids, merged = self.merges.encode_words(fresh)
            self.merged += merged
            known = dict(zip(fresh, ids)).__getitem__
            self.chunks.update(zip(part, [known(ws[0]) if len(ws) == 1 else b"".join(map(known, ws)) for ws in words]))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        docs, used = [], set()
        for t in texts:
            parts: list = []
            for s in self.segments(t or ""):
                if isinstance(s, str):
                    s = self.split(s)
                    used.update(s)
                parts.append(s)
            docs.append(parts)
        chunks = self.chunks
        new = [c for c in used if c not in chunks]
        if new:
            self._learn(new)
        out = []
        for parts in docs:
            ids = b"".join(np.int32(s).tobytes() if isinstance(s, int) else b"".join(map(chunks.__getitem__, s)) for s in parts)
            out.append(np.frombuffer(ids, dtype=np.int32))
        if len(chunks) > CACHE:     # what these texts used is likely to come again
            self.chunks = {c: chunks[c] for c in used}
        return out

    def decode(self, rows):
        """Arrow list column of ids -> string column; null as empty."""
        import pyarrow as pa
        import pyarrow.compute as pc

        rows = rows.fill_null([]) if rows.null_count else rows
        if self.decoder is None:
            tokens = self.table.take(rows.flatten())
            return pc.binary_join(pa.ListArray.from_arrays(_offsets(rows), tokens), " ")
        data = [b"".join(map(self.data.__getitem__, ids)) for ids in rows.to_pylist()]
        return pa.array([d.decode("utf-8", errors="replace") for d in data], type=pa.string())


def _offsets(rows):
    """Offsets of an Arrow list column into its flattened values."""
    import pyarrow as pa

    offsets = np.asarray(rows.offsets)
    return pa.array((offsets - offsets[0]).astype(np.int32))


def kept_by_worker(specs: tuple[bytes, ...], make):
    """``make(*specs)``, kept by the Python worker for its next tasks."""
    import sys
    import types

    held = sys.modules.setdefault("_kindred_tokenizers", types.ModuleType("_kindred_tokenizers")).__dict__
    key = make.__name__ + "".join(hashlib.sha256(s).hexdigest() for s in specs)
    if key not in held:
        held[key] = make(*specs)
    return held[key]


def runs(sizes: list[int], limit: int = 1 << 21):
    """(start, stop) of consecutive rows with about ``limit`` in sum, one row at least."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def list_column(rows: list[np.ndarray], kind):
    """Arrow list column of numpy rows."""
    import pyarrow as pa

    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))


def file_bytes(df: DataFrame, path: str):
    """A vocabulary file, read once by the driver and broadcast; its size is that of
    the public file and does not grow with the data."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int) with the encoding of ``text``."""
    spec = file_bytes(docs, path)

    def run(columns):
        import pyarrow as pa

        encoder = kept_by_worker((spec.value,), Encoder)
        for col in columns:
            texts, out = col.to_pylist(), []
            for a, b in runs([len(t or "") for t in texts]):
                out += encoder.encode(texts[a:b])
            yield list_column(out, pa.int32())

    return docs.withColumn(ids, _iterating(run, "array<int>")(F.col(text)))


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text`` with the decoding of ``ids``, special tokens kept; null as empty."""
    spec = file_bytes(docs, path)

    def run(columns):
        encoder = kept_by_worker((spec.value,), Encoder)
        for col in columns:
            yield encoder.decode(col)

    return docs.withColumn(text, _iterating(run, "string")(F.col(ids)))


def _iterating(run, kind: str):
    from collections.abc import Iterator

    import pyarrow as pa

    run.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)


def encode_decode(docs: DataFrame, path: str, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep``, ``ids`` and ``decoded`` of every document, in one pass: a task has one
    worker with one copy of the tables."""
    spec = file_bytes(docs, path)
    keep = list(keep)

    def run(batches):
        import pyarrow as pa

        encoder = kept_by_worker((spec.value,), Encoder)
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for a, b in runs([len(t or "") for t in texts]):
                ids = list_column(encoder.encode(texts[a:b]), pa.int32())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(len(keep))),
                                                  ids, encoder.decode(ids)], names=[*keep, "ids", "decoded"])

    kinds = dict(docs.dtypes)
    schema = "".join(f"{c} {kinds[c]}, " for c in keep) + "ids array<int>, decoded string"
    return docs.select(*keep, text).mapInArrow(run, schema)


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return encode_decode(docs, path, ["doc_id"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"))


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
