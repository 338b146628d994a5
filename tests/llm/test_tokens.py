"""BPE encoding, cross-tokenizer alignment and the source audit against the libraries
and plain Python, with nulls, empty and long texts, repeated rows, empty tables and
clashing column names."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kindred.llm import bpe, source_audit, token_align

WORD, BYTE, PIECE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string, lang string, source string, ids string, term string, block string, n string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, l, s, "x", "y", "z", "n") for i, t, l, s in rows], DOCS)


def odd_texts(seed, n):
    rng = random.Random(seed)
    letters = "\x1c\x85\xa0\u2028aaaeeeinnstrhldu  bcoAEIÄé'`’ßΣσİ漢字　\t\n0123<|>😀👍🏽​ﬁ▁\x00"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


TEXTS = [None, "", "   ", "It's 12 o'clock", "a<|endoftext|>b <|startoftext|><|endoftext|>x<|ENDOFTEXT|>", "a" * 3000,
         "xyz" * 20_000, "wort " * 20_000, "<s></s><0x41> <unk>", *odd_texts(1, 300)]


@pytest.fixture(scope="module")
def rows():
    return [(None if i == 3 else i // 2, t, ["en", "de", None][i % 3], ["a", "b", None, ""][i % 4]) for i, t in enumerate(TEXTS)]


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# --- 11 BPE
def test_words_equal_library():
    for path in (WORD, BYTE):
        with open(path, "rb") as f:
            own = bpe.Encoder(f.read())
        library = Tokenizer.from_file(path)
        words = sorted({w for t in odd_texts(2, 3000) for w, _ in library.pre_tokenizer.pre_tokenize_str(t.lower())})
        got, merged = own.merges.encode_words(words)
        assert got == [own.merges.merge([w])[0] for w in words] == own.merges.merge(words)
        assert 0 < merged < len(words)          # both ways are taken
        assert own.merges.trusted.all() and own.merges.sound


def test_batch_and_heap_merge_agree(monkeypatch):
    with open(WORD, "rb") as f:
        own = bpe.Encoder(f.read()).merges
    rng = random.Random(3)
    words = ["".join(rng.choice("aabnest") for _ in range(rng.randrange(1, 60))) for _ in range(500)]
    short = own.merge(words)
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert own.merge(words) == short


def test_forgotten_chunks_are_learnt_again(monkeypatch):
    with open(WORD, "rb") as f:
        spec = f.read()
    texts = [t for t in TEXTS if t]
    want = [x.tolist() for x in bpe.Encoder(spec).encode(texts)]
    monkeypatch.setattr(bpe, "CACHE", 3)
    own = bpe.Encoder(spec)
    assert [own.encode([t])[0].tolist() for t in texts] == want


def test_untrusted_tokens_are_not_proposed():
    # "abc" can be spelled, but its own encoding is a + bc
    spec = {"model": {"vocab": {c: i for i, c in enumerate(["a", "b", "c", "bc", "ab", "abc"])},
                      "merges": [["b", "c"], ["a", "b"], ["ab", "c"]]}}
    own = bpe.Merges(spec)
    assert not own.trusted[5] and own.trusted[:5].all()
    got = own.encode_words(["abc", "ab", "abab", "bcab"])[0]
    assert [np.frombuffer(x, np.int32).tolist() for x in got] == [[0, 3], [4], [4, 4], [3, 4]]


def test_encode_decode_equal_library(spark, rows):
    library = Tokenizer.from_file(WORD)
    df = docs_of(spark, rows)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe.digest(df, WORD).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bpe.digest(df.limit(0), WORD).count() == 0
    kept = bpe.encode(df, WORD, ids="out")
    assert kept.columns == [*df.columns, "out"]


def test_byte_level_decoding(spark):
    library = Tokenizer.from_file(BYTE)
    ids = [library.encode(t or "").ids for t in TEXTS[:60]] + [[50256, 100, 220, 447], []]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, BYTE).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)}


# --- 12 alignment
def alignment_brute(rows):
    a, b = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a.encode_special_tokens = True
    letters, names = bpe.byte_letters(), {i: s for s, i in a.get_vocab().items()}
    docs, held = [], collections.Counter()
    for i, t in rows:
        text, x, y = (" " + (t or "")).encode(), [], []
        if t:
            x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        bx = [bytes(letters[c] for c in names[k]) for k in x]
        by = [bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode() for k in y]
        if b"".join(bx) != text or b"".join(by) != text:
            x, y, bx, by = [], [], [], []
        ex, ey = np.cumsum([len(k) for k in bx]).tolist(), np.cumsum([len(k) for k in by]).tolist()
        groups, link, p, q = [], [], 0, 0
        for end in sorted(set(ex) & set(ey)):
            u, v = ex.index(end) + 1, ey.index(end) + 1
            groups.append(",".join(map(str, x[p:u])) + "|" + ",".join(map(str, y[q:v])))
            link += [(x[m], y[n]) for m in range(p, u) for n in range(q, v)
                     if ex[m] - len(bx[m]) < ey[n] and ey[n] - len(by[n]) < ex[m]]
            p, q = u, v
        docs.append((i, len(x), len(y), len(groups), link, ";".join(groups)))
        held.update(set(link))
    top = collections.Counter()
    for (m, _), c in held.items():
        top[m] = max(top[m], c)
    return [(i, nx, ny, ng, len(k), sum(held[z] == top[z[0]] for z in k), sum(held[z] for z in k), sha(g) if g else "")
            for i, nx, ny, ng, k, g in docs]


def test_alignment_brute_force(spark, rows):
    small = [r for r in rows if len(r[1] or "") < 10_000]
    df = docs_of(spark, small)
    want = alignment_brute([r[:2] for r in small])
    assert any(r[1] for r in want) and any(not r[1] and t for r, (_, t, *_) in zip(want, small))
    got = [tuple(r) for r in token_align.digest(df.repartition(5), BYTE, PIECE).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert token_align.digest(df.limit(0), BYTE, PIECE).count() == 0


def test_alignment_long_text_and_blocks(spark):
    text = "Ein Wort, naïve 漢字! " * 4000
    rows = [(1, text), (2, text), (2, text), (3, "Ein Wort"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in token_align.align_documents(df.coalesce(1), BYTE, PIECE).collect()}
    again = {r.doc_id: r for r in token_align.align_documents(df.repartition(5), BYTE, PIECE).collect()}
    assert got == again                                     # blocks do not show in the result
    assert got[1].n_links == got[2].n_links == got[1].n_a + got[1].n_b - got[1].n_groups
    assert got[4].n_a == 0 and got[4].groups == ""
    assert (token_align.aligned(df, BYTE, PIECE).filter("role = 0").count()) == 5


def test_alignment_forgets_and_learns_again(monkeypatch):
    with open(BYTE, "rb") as a, open(PIECE, "rb") as b:
        specs = a.read(), b.read()
    texts = [t or "" for t in TEXTS if len(t or "") < 10_000]
    own = token_align.Tokenizers(*specs)
    assert own.cuts
    want = [(c, g, k.tolist()) for c, g, k in own.align(texts)]
    own.forget()
    own.cuts = False            # whole texts as one piece each
    assert [(c, g, k.tolist()) for c, g, k in own.align(texts)] == want
    monkeypatch.setattr(token_align, "CACHE", 2)
    again = token_align.Tokenizers(*specs)
    assert [(c, g, k.tolist()) for t in texts for c, g, k in again.align([t])] == want


def test_many_pieces_are_encoded_as_one_text():
    with open(BYTE, "rb") as a, open(PIECE, "rb") as b:
        own, single = (token_align.Tokenizers(*specs) for specs in [(a.read(), b.read())] * 2)
    asked = []
    encode = own.encode
    own.encode = lambda texts: asked.extend(texts) or encode(texts)
    texts = [" ".join(f"word{i} naïve {chr(0x4E00 + i)}, x<s>{i}" for i in range(500)), "  two \n spaces ", "a\u2581b \ufb01 c", "é" * 50, "\x1c a \x1c"]
    got = [(c, g, k.tolist()) for c, g, k in own.align(texts)]
    assert len(asked) < 150 < 1000 < len(own.number)
    single.cuts = False         # whole texts as one piece each
    assert got == [(c, g, k.tolist()) for c, g, k in single.align(texts)]
    assert got[0][0][0] and got[2] == ((0, 0, 0, 0), "", [])


# --- 13 source audit
def audit_brute(rows, min_docs, top):
    low = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    n, held, groups = collections.Counter(), collections.Counter(), set()
    for _, t, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [w.translate(low) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")]
        groups.add((lang, source))
        n.update((lang, source, w) for w in terms)
        held.update((lang, w) for w in set(terms))
    out = []
    for lang, source in groups:
        kept = [w for (k, w), c in held.items() if k == lang and c >= min_docs]
        own = [s for k, s in groups if k == lang]

        def p(s, w):
            names = own if s is None else [s]
            total = sum(n[lang, x, v] for x in names for v in kept)
            return 1 + 10**9 * (sum(n[lang, x, w] for x in names) + 5) // (total + 5 * len(kept))

        pairs = [(sum(abs(p(source, w) - p(s, w)) for w in kept), s) for s in own if s != source]
        terms = [(p(source, w) - p(None, w), w) for w in kept if n[lang, source, w] and p(source, w) > p(None, w)]
        for part, items, last in (("pair", pairs, None), ("term", terms, top)):
            items = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:last]
            out += [(lang, source, part, item, value, r) for r, (value, item) in enumerate(items, 1)]
    return sorted(out)


def test_audit_brute_force(spark):
    rng = random.Random(5)
    words = ["Alpha", "alpha", "beta", "éclair", "Éclair", "gamma-ray", "abcdefgh", "abcdefghi", "abcdefghijklmnopq", "ﬁ", "漢字", "x1y"]
    rows = [(rng.randrange(20), " ".join(rng.choices(words, k=rng.randrange(0, 12))), rng.choice(["en", "de", "fr"]),
             rng.choice(["a", "b", "b", "c", "B", None, ""])) for _ in range(120)]
    rows += [(1, None, None, None), (2, "", "", "q"), (3, "only here", "it", "solo"), (4, "1 2 3", "en", "bare"),
             (5, "alpha " * 50_000 + "z" * 100_000, "en", "a"), (6, "alpha", "en", "a"), (6, "alpha", "en", "a")]
    df = docs_of(spark, rows)
    for parts in (1, 9):
        got = source_audit.audit_sources(df.repartition(parts), min_docs=3, top=4)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == audit_brute(rows, 3, 4)
    assert source_audit.audit_sources(df.limit(0)).count() == 0


def test_pointer_sort_orders_terms():
    rng = random.Random(6)
    terms = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    data = np.frombuffer(" ".join(terms).encode(), dtype=np.uint8)
    starts, sizes, doc = source_audit.term_pointers(data, np.array([0, len(data)]))
    assert [bytes(data[s:s + n]).decode() for s, n in zip(starts, sizes)] == terms and not doc.any()
    order, run = source_audit.pointer_sort(data, starts, sizes)
    ordered = [terms[i] for i in order]
    assert ordered == sorted(terms)
    assert [terms[order[r]] for r in run] == ordered


def test_pieces_are_cut_before_single_spaces():
    import random
    import re

    from kindred.llm.token_align import Tokenizers, links
    import numpy as np

    rng = random.Random(5)
    cutter = Tokenizers.__new__(Tokenizers)
    cutter.cuts = True
    for _ in range(3000):
        text = "".join(rng.choice(" \n\t 　ab") for _ in range(rng.randint(1, 12)))
        assert cutter.pieces(text) == re.split(r"(?<=\S)(?= \S)", " " + text)
    for _ in range(300):
        a, b = (np.cumsum([rng.randint(1, 4) for _ in range(rng.randint(0, 9))] or [0], dtype=np.int64) for _ in range(2))
        closing = sorted(set(a.tolist()) | set(b.tolist()))
        assert [x.tolist() for x in links(a, b)] == [np.searchsorted(e, closing).tolist() for e in (a, b)]
