"""Pattern spans against plain regular expressions, the battery against its definitions."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa

from tallyguard.llm import scan, secret_scan

SMALL = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
COLUMNS = "doc_id long, text string, base string, tested int, start int, kind string, cell int, ordinary string"


def plain(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return spans + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]


def written(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def check(docs):
    found = {}
    for row in secret_scan.secrets(docs).collect():
        found.setdefault(row.doc_id, []).append(row)
    for row in docs.select("doc_id", "text").collect():
        spans = plain(row.text or "")
        base = hashlib.sha256(written(spans).encode()).hexdigest()
        mine = [f for f in found[row.doc_id] if f.base_sha256 == base]
        assert mine, (row.doc_id, spans)
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        assert [mine[0].n_assign, mine[0].n_access, mine[0].n_hex] == counts
        listed = [x for x in mine[0].spans.split(",") if x and not x.startswith("random")]
        assert ",".join(listed) == written(spans) and len(mine[0].spans.split(",") if mine[0].spans else []) == len(spans) + mine[0].n_random
    return found


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = check(docs)
    assert len(found) == docs.count()
    assert sum(r.n_assign + r.n_access + r.n_hex for rows in found.values() for r in rows) > 0


def test_odd_rows(spark):
    key = "AKIA" + "Z9" * 6
    texts = [
        None, "", " ", "password=abcdefgh", "PASSWD : 'abc", "token: secret: abcdefghijk", f"é{key}ß {key}7", "AKIA" + "Q" * 11,
        "ü" * 40 + "0123456789abcdef" * 2, "a" * 31, "f" * 5000, 'Api_Key"="x/+=_.-y12', "apikey=" + "ab12" * 8, "toKen=abcdefghij ſecret=abcdefghij",
        "password", "passwordsecret=token=12345678", "AKIAAKIA" + "A" * 20, "password= \n abcdefgh", "word " * 60_000 + "secret='deadbeefdeadbeef'",
    ]
    rows = [(i if i % 5 else None, t, "x", 1, 2, "k", 3, "o") for i, t in enumerate(texts)] + [(3, "token=aaaaaaaa", "x", 1, 2, "k", 3, "o")] * 2
    docs = spark.createDataFrame(rows, COLUMNS)
    check(docs)
    assert secret_scan.secrets(docs).count() == len(rows)
    assert secret_scan.secrets(docs.limit(0)).count() == 0


def test_spans_do_not_reach_into_the_next_row(spark):
    rows = [(1, "password", *["x"] * 0), (2, "=abcdefghij"), (3, "0123456789abcdef"), (4, "0123456789abcdef"), (5, "AKIAAAAAAAA"), (6, "AAAAAAAA")]
    found = secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert all(r.spans == "" for r in found)


def deviates(symbols, k):
    n = len(symbols)
    chi = sum((symbols.count(s) - n / k) ** 2 / (n / k) for s in range(k))
    spread = 2 / (9 * (k - 1))
    uniform = ((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)
    high = [s >= k // 2 for s in symbols]
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    up, down = sum(high), n - sum(high)
    mean, variance = 1 + 2 * up * down / n, 2 * up * down * (2 * up * down - n) / (n * n * (n - 1))
    mid = (k - 1) / 2
    serial = sum((a - mid) * (b - mid) for a, b in zip(symbols, symbols[1:])) / ((k * k - 1) / 12 * math.sqrt(n - 1))
    return uniform, (runs - mean) / math.sqrt(variance) if variance > 0 else -math.sqrt(n), serial


def test_battery_is_what_it_says():
    draw = random.Random(5)
    for k, _ in secret_scan.ENCODINGS:
        strings = [[draw.randrange(k) for _ in range(draw.randrange(16, 90))] for _ in range(40)] + [[0] * 20, [k - 1, 0] * 10]
        sizes = np.array([len(s) for s in strings])
        found = secret_scan.battery(np.concatenate(strings), np.cumsum(sizes) - sizes, k)
        np.testing.assert_allclose(found.T, [deviates(s, k) for s in strings], atol=1e-9)


def test_deviates_of_random_strings_are_standard_normal():
    symbols = np.random.default_rng(1).integers(0, 64, 64 * 20_000)
    found = secret_scan.battery(symbols, np.arange(20_000) * 64, 64)
    assert (abs(found.mean(axis=1)) < 0.1).all() and (abs(found.std(axis=1) - 1) < 0.1).all()


def test_null_windows_do_not_depend_on_slices():
    draw = random.Random(3)
    texts = ["".join(draw.choice("abc deXYZ019+") for _ in range(draw.randrange(0, 4000))) for _ in range(30)]

    def counted(part):
        data, bounds = scan.text_buffer(pa.array(part))
        return secret_scan._null(data, bounds, np.zeros(len(data), dtype=bool))

    whole = counted(texts)
    assert (whole == sum(counted([t]) for t in texts)).all()
    assert whole[:, :].sum() > 100


def test_random_strings_are_found_among_ordinary_ones(spark):
    draw = random.Random(11)
    words = [w for r in spark.read.parquet(f"{SMALL}/documents.parquet").where("text IS NOT NULL").collect() for w in re.findall(r"[A-Za-z]+", r.text)]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    rows = []
    for i in range(600):
        text = " ".join(draw.choices(words, k=300))
        if i % 3 == 0:
            text += " see " + "".join(draw.choices(letters, k=64)) + " there"
        elif i % 3 == 1:
            text += " see " + "".join(draw.choices(words, k=12))[:64] + " there"
        rows.append((i, text))
    found = secret_scan.secrets(spark.createDataFrame(rows, "doc_id long, text string"), alpha=0.05).toPandas()
    assert found[found.doc_id % 3 == 0].n_random.mean() > 0.8
    wrong = found[found.doc_id % 3 != 0].n_random.sum()
    assert wrong <= 0.1 * found.n_random.sum()
