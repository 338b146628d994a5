import hashlib

from kindred.operators.signature import simhash


def model(text, bits=64):
    if not text:
        return 0
    sh = [text[i:i + 3] for i in range(len(text) - 2)] or [text]
    v = [0] * bits
    for s in sh:
        h = int(hashlib.md5(s.encode("utf-8")).hexdigest(), 16)
        for i in range(bits):
            v[i] += 1 if (h >> i) & 1 else -1
    out = 0
    for i in range(bits):
        if v[i] > 0:
            out |= 1 << i
    return out


def signed(u):
    return u - (1 << 64) if u >= 1 << 63 else u


def test_simhash_matches_python_model(spark):
    texts = ["", "a", "ab", "abc", "abcd", "你好吗我", "hello world", "the quick brown fox jumps",
             "aaaaaaaaaaaaaaaa", "xyzxyzxyz" * 20]
    df = spark.createDataFrame([(i, "k", t) for i, t in enumerate(texts)], "id long, kind string, value string")
    got = {r.id: r.h for r in simhash(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == signed(model(t)), t


def test_abc_literal(spark):
    df = spark.createDataFrame([(1, "k", "abc")], "id long, kind string, value string")
    assert simhash(df).first().h == signed(15462616177412505458)
