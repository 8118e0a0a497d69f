"""The training-data operators against brute force, round trips and odd input."""

import collections
import hashlib
import math
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyguard.llm import chat, grammar, language, minhash, mixing, neighbours, packing, quality, queries, rules, scan, suffixes, tokens

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n string, band int, key int, size int, c int, item int, copies int, part int, host int"
LONG = " ".join(f"wort{i % 977} ünd{i % 13}" for i in range(20_000))


def odd_rows():
    base = [
        (1, "The cat sat on the mat and the dog ran off", "en", "a"),
        (2, "the CAT sat on the mat and the dog ran off", "en", "a"),
        (3, None, None, None),
        (4, "", "en", "b"),
        (5, "  \t\n ", "de", "b"),
        (6, LONG, "de", "b/x"),
        (7, LONG, "de", None),
        (8, "one", "fr", "c"),
        (9, "12 345 !!", None, "c"),
        (None, "no id here but some words", "en", None),
        (None, None, None, None),
        (10, "same row twice", "en", "a"),
        (10, "same row twice", "en", "a"),
        (11, "é" * 900, "fr", "a"),
        (12, "x" * 3000 + "ß" + "x" * 900, "xx", "a"),
    ]
    return [(*b, 0, "n", 1, 2, 3, 4, 5, 6, 7, 8) for b in base]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0, "x"), (8, 0, None, "y"), (None, 1, 1, "z"), (9, None, None, "z"), (1, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


# Words and hashes


def test_words_and_hashes():
    text = ["a b", None, "", "  é\tX\x0bé ", "a"]
    data, bounds = scan.text_buffer(pa.array(text))
    start, end, row = scan.words(data, bounds)
    assert [(r, bytes(data[a:b]).decode()) for a, b, r in zip(start, end, row)] == [(0, "a"), (0, "b"), (3, "é"), (3, "X"), (3, "é"), (4, "a")]
    hasher = scan.Hasher(1)
    h = hasher.of(hasher.sums(data), start, end)
    assert h[0] == h[5] and h[2] == h[4] and len(set(h.tolist())) == 4
    assert [s for s in scan.slices(bounds, 3)][-1][1] == 5


def test_sliced_arrow_columns():
    column = pa.array(["aa", "bb", None, "cc"]).slice(1)
    data, bounds = scan.text_buffer(column)
    assert bytes(data) == b"bbcc" and bounds.tolist() == [0, 2, 2, 4]


# 1 Quality classifier


def test_classifier_catches_toxic_and_poor(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    learned = labels.where("pmod(doc_id, 3) > 0")
    held = quality.classified(docs, learned).join(labels.where("pmod(doc_id, 3) = 0"), "doc_id").toPandas()
    bad = (held.quality == 0) | (held.toxic == 1)
    assert held[~bad].kept.mean() > 0.98
    assert (~held[held.toxic == 1].kept).mean() > 0.93
    assert (~held[held.quality == 0].kept).mean() > 0.93


def test_sites_shrink_towards_their_priors(spark):
    words = ["fine text about rivers and hills", "awful awful junk"]
    rows = [(i, words[int(i % 10 < (9 if i % 2 else 1))] + f" w{i}", "en", "bad/p" if i % 2 else "good/p") for i in range(400)]
    rows.append((1000, "fine text about rivers and hills", "en", "single/q"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = docs.select("doc_id", (~F.col("text").startswith("awful")).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    sites = quality.classified(docs, labels).groupBy("host").agg(F.avg("site_rate").alias("rate")).toPandas().set_index("host").rate
    assert sites["good"] < sites["single"] < sites["bad"]


def test_classifier_on_odd_input(spark, odd, empty, labels):
    result = quality.classified(odd, labels).toPandas()
    assert len(result) == len(odd_rows()) and result.p_bad.between(0, 1).all()
    assert quality.classified(empty, labels).count() == 0
    assert quality.classified(odd, labels.limit(0)).where("kept").count() == len(odd_rows())


# 2 Near-duplicates


def shingles(text, k):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute_components(sets):
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            common = len(a & b)
            if a and b and 100 * common >= 80 * (len(a) + len(b) - common):
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_copies(rng, n):
    """Chains and families at similarities around the threshold."""
    rows, base = [], [f"w{rng.integers(0, 5000)}" for _ in range(120)]
    for i in range(n):
        words = list(base)
        for at in rng.integers(0, len(words), rng.integers(0, 22)):
            words[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((int(i), " ".join(words)))
        if i % 40 == 39:
            base = [f"w{rng.integers(0, 5000)}" for _ in range(rng.integers(3, 200))]
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, documents, k):
    made = near_copies(np.random.default_rng(k), 240)
    docs = spark.createDataFrame([(100_000 + i, t) for i, t in made], "doc_id long, text string").unionByName(documents.select("doc_id", "text"))
    sets = {i: shingles(t, k) for i, t in texts(docs).items()}
    expected = brute_components(sets)
    found = {r.doc_id: r for r in minhash.near_duplicates(docs, minhash.Shape(words=k)).collect()}
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert all(r.kept == (i == expected[i]) for i, r in found.items())


def test_near_duplicates_on_odd_input(odd, empty):
    rows = minhash.near_duplicates(odd, minhash.Shape(words=2)).toPandas()
    assert len(rows) == len(odd_rows())
    component = rows[rows.doc_id.notna()].set_index("doc_id").component_id
    assert component[2] == 1 and component[7] == 6 and component[4] == 4 and component[3] == 3
    assert rows[rows.doc_id.isna()].component_id.isna().all() and rows[rows.doc_id.isna()].kept.all()
    assert minhash.near_duplicates(empty).count() == 0


def test_densified_bins_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = scan.seeded(4, 60)
    a, b = pool[:50], pool[10:]
    row = np.repeat([0, 1], 50)
    signature = minhash.sketch(row, np.concatenate((a, b)), 2, 2000)
    assert not (signature == minhash.EMPTY).any()
    assert abs((signature[0] == signature[1]).mean() - 40 / 60) < 0.12
    assert rng is not None


# 3 Language


def test_gradients_are_right():
    net = language.Net(hidden=3, window=7)
    model, rng = language.BiGru(["a", "b", "c"], net), np.random.default_rng(0)
    x = rng.integers(0, 256, (7, 5)).astype(np.uint8)
    valid = (np.arange(7)[:, None, None] < np.array([7, 3, 7, 5, 1])).astype(np.float64)
    label = np.array([0, 1, 2, 1, 0])
    model.weights = {k: w.astype(np.float64) for k, w in model.weights.items()}
    _, grads = model.gradients(x, valid, label)
    for name, w in model.weights.items():
        for at in [(0, int(x[0, 0])), (1, int(x[1, 1]))] if name[0] == "w" else [(0, 0), (w.shape[0] - 1, w.shape[1] - 1)]:
            old, step = w[at], 1e-3
            w[at] = old + step
            up = model.gradients(x, valid, label)[0]
            w[at] = old - step
            down = model.gradients(x, valid, label)[0]
            w[at] = old
            assert abs((up - down) / 2 / step - grads[name][at]) < 2e-3


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = language.Net()
    result = language.languages(docs, net).join(docs, "doc_id").toPandas()
    assert (result.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in result.doc_id]).all()
    held = result[result.held_out & result.lang.notna()]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.95
    assert result.score.between(0, 1).all()


def test_languages_beyond_64_are_learned(spark):
    # Every language has its own letter; the last six are rarer.
    names = [f"l{n:02}" for n in range(70)]
    letter = [chr(c) for c in range(33, 127) if chr(c).isalpha()] + [chr(c) for c in range(0x3B1, 0x3C3)]
    own = dict(zip(names, letter))
    rows = [(10 * i + n * 1000, f"{own[name] * 3} " * 20, name) for n, name in enumerate(names) for i in range(9 if n < 64 else 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(language._prepared(docs))
    assert model.languages == names
    found = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    rare = found[found.lang >= "l64"]
    assert (rare.lang == rare.lang_pred).mean() > 0.9 and (found.lang == found.lang_pred).mean() > 0.9
    assert model.at_once() < 2048 and language.BiGru(["a"], language.Net()).at_once() == 2048
    with pytest.raises(ValueError, match="more than 69"):
        language.fit(language._prepared(docs), language.Net(languages=69))


def test_every_position_has_a_label(spark, documents):
    model = language.BiGru(["a", "b"], language.Net(window=16))
    rows = language.position_labels(documents.limit(20), model).toPandas()
    sizes = {i: len(t.encode()) for i, t in texts(documents.limit(20)).items()}
    assert (rows.b - rows.a).groupby(rows.doc_id).sum().to_dict() == {i: n for i, n in sizes.items() if n}


def test_language_on_odd_input(odd, empty):
    rows = language.languages(odd, language.Net(steps=5)).toPandas()
    assert len(rows) == len(odd_rows())
    known = rows[rows.doc_id.notna()].drop_duplicates("doc_id").set_index("doc_id")
    assert (known.lang_pred[[3, 4, 5, 9]] == "und").all() and (known.score[[3, 4, 5, 9]] == 0).all()
    assert set(known.lang_pred) <= {"en", "de", "fr", "xx", "und"}
    assert language.languages(empty).count() == 0
    assert set(r.lang_pred for r in language.languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()) == {"und"}


# 4, 9 Token ids


def reference_ids(text):
    encoder = tokens.encoder(tokens.default_path())
    return [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


ODD_TEXTS = [
    "", "a", " a", "a ", "  a  b\n\n c\t\td \n", "it's we're 'tis don''t x'sx ", "<|endoftext|>hi <|endoftext|>", "é,è. ü! ñ?", "a\x85b \x1c c",
    "x\r\ny\x0bz", "日本語 テキスト。", "a,b;c:'d'", "1,234.5 a1,b2", "...a", "🙂 🙂a", "a  b  c 　d", "ſs 'Ⅷ ²x", "&&& the&&& x's%%% '%%%",
]


def test_encoder_equals_the_tokenizer():
    encoder = tokens.Encoder(tokens.default_path())
    for _ in range(2):
        got = [ids[b[i] : b[i + 1]].tolist() for a, e, ids, b in encoder.column(pa.array(ODD_TEXTS)) for i in range(e - a)]
        assert got == [reference_ids(t) for t in ODD_TEXTS]


def test_packing(spark, documents, odd):
    for docs in (documents, odd):
        rows = packing.packed_documents(docs, tokens.default_path()).toPandas()
        expected = collections.Counter()
        for r in docs.select("doc_id", "text").collect():
            ids, n = reference_ids(r.text), len(reference_ids(r.text))
            at, piece = 0, 0
            while at < n:
                size = (n % 2048 or 2048) if piece == 0 else 2048
                expected[(r.doc_id, piece, at, size, zlib.crc32(np.array(ids[at : at + size], dtype="<u4").tobytes()))] += 1
                at, piece = at + size, piece + 1
        ids = [None if math.isnan(i) else int(i) for i in rows.doc_id]
        assert collections.Counter(zip(ids, rows.piece, rows.start, rows.length, rows.ids_crc32)) == expected
        for _, group in rows.sort_values("offset").groupby("sequence_id"):
            assert (group.offset == group.length.cumsum() - group.length).all() and group.length.sum() <= 2048
        bound = packing.lower_bound(rows.length.to_numpy(), 2048)
        assert bound <= rows.sequence_id.nunique() <= bound * 1.02 + 1


def test_bounds_and_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(30):
        length = rng.integers(1, 101, rng.integers(1, 60))
        bin_, offset = packing.best_fit_decreasing(length, 100)
        filled = np.bincount(bin_, weights=length)
        assert filled.max() <= 100 and packing.lower_bound(length, 100) <= len(filled)
        for b in range(len(filled)):
            at = np.argsort(offset[bin_ == b])
            assert (offset[bin_ == b][at] == np.cumsum(length[bin_ == b][at]) - length[bin_ == b][at]).all()
    assert packing.lower_bound(np.array([51] * 7), 100) == 7
    assert packing.lower_bound(np.array([34] * 7), 100) == 4


def test_partitions_exchange_documents(spark):
    rng = np.random.default_rng(2)
    items = spark.createDataFrame([(i, int(n)) for i, n in enumerate(rng.integers(1, 2048, 3000))], "item long, length long")
    sizes = packing.Sizes(items=100)
    placed = packing.pack_items(items, sizes).join(items, "item").toPandas()
    assert len(placed) == 3000
    bins = placed.groupby(["turn", "part", "bin"]).length.sum()
    alone = packing._bins(packing._packed(items, 30, 0, 2048))
    assert bins.max() <= 2048 and len(bins) < alone


def test_token_blocks_round_trip(spark, documents, odd):
    for docs in (documents, odd):
        blocks = grammar.write_blocks(docs, tokens.default_path(), grammar.Layout(block=4000, least=4, stride=16))
        rows = grammar.decode(blocks).toPandas()
        source = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
        at, expected = 0, []
        for r in source:
            ids = reference_ids(r.text)
            expected.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
            at += len(ids)
        ids = [None if math.isnan(i) else int(i) for i in rows.doc_id]
        key = lambda x: x[1]
        assert sorted(zip(ids, rows.start, rows.n_tokens, rows.ids_crc32), key=key) == expected
        for row in blocks.collect():
            block = grammar.Block(row.payload)
            whole = block.ids()
            for n in range(len(block.doc_ids)):
                assert (block.document(n) == whole[block.starts[n] : block.starts[n + 1]]).all()
    assert len(block.rules) > 0


def token_ids(encoder, texts):
    return [ids[b[i] : b[i + 1]].tolist() for a, e, ids, b in encoder.column(pa.array(texts)) for i in range(e - a)]


class Asked:
    """A tokenizer that counts the strings it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.strings = tokenizer, 0

    def encode_batch_fast(self, strings, **more):
        self.strings += len(strings)
        return self.tokenizer.encode_batch_fast(strings, **more)


def test_new_pieces_are_encoded_in_runs():
    words = [f"{a}{b}{mark}" for a in ("ab", "é", "x1", "'t", "ſs") for b in string.ascii_lowercase for mark in ("", "q!", "ü,")]
    texts = [" ".join(words), "\n".join(words), ",".join(words), *words]
    encoder = tokens.Encoder(tokens.default_path())
    asked = encoder.tokenizer = Asked(encoder.tokenizer)
    assert token_ids(encoder, texts) == [reference_ids(t) for t in texts]
    assert 0 < asked.strings < 10
    # Where the ends of pieces are no ends of tokens, each is asked for alone.
    encoder = tokens.Encoder(tokens.default_path())
    encoder.bytes_of[:] = 3
    assert token_ids(encoder, [*texts, *ODD_TEXTS]) == [reference_ids(t) for t in [*texts, *ODD_TEXTS]]


def test_blocks_end_with_the_document_that_fills_them(spark):
    docs = spark.createDataFrame([(i, "one two three four " * 5) for i in range(300)], "doc_id long, text string").coalesce(1)
    size = len(reference_ids("one two three four " * 5))
    blocks = grammar.write_blocks(docs, tokens.default_path(), grammar.Layout(block=10 * size - 3))
    found = blocks.toPandas()
    assert found.n_ids.max() <= 10 * size and found.n_ids.sum() == 300 * size
    assert (found.sort_values(["part", "seq"]).groupby("part").n_docs.apply(lambda n: (n.iloc[:-1] == 10).all())).all()


def test_symbols_expand_at_once():
    for ids in (np.tile(np.arange(7), 500), np.zeros(1001), np.arange(50), np.zeros(0)):
        rules_, symbols = grammar.compress(ids.astype(np.uint32), 50, grammar.Layout(rounds=6, least=2))
        lengths = grammar.expansion_lengths(rules_, 50)
        assert (grammar.expand_all(symbols, rules_, lengths, 50) == ids).all()
        assert (grammar.expand(symbols, rules_, 50) == ids).all()


def test_grammar_makes_repeats_short():
    ids = np.tile(np.arange(100, dtype=np.uint32), 200)
    rules_, symbols = grammar.compress(ids, 50_257, grammar.Layout(rounds=8))
    assert len(symbols) < len(ids) / 50
    assert (grammar.expand(symbols, rules_, 50_257) == ids).all()
    same = np.zeros(1001, dtype=np.uint32)
    rules_, symbols = grammar.compress(same, 50_257, grammar.Layout())
    assert (grammar.expand(symbols, rules_, 50_257) == same).all()


def test_tokens_of_empty_tables(empty):
    assert packing.packed_documents(empty, tokens.default_path()).count() == 0
    assert grammar.decode(grammar.write_blocks(empty, tokens.default_path())).count() == 0


# 5 Repeated passages


def covered(rows, size, keep_first):
    places = collections.defaultdict(list)
    for n, text in enumerate(rows):
        for at in range(len(text) - size + 1):
            places[text[at : at + size]].append((n, at))
    out = [np.zeros(len(t), dtype=bool) for t in rows]
    for found in places.values():
        for n, at in found[1:] if keep_first else (found if len(found) > 1 else []):
            out[n][at : at + size] = True
    return out


def passages(rng):
    shared = [bytes(rng.integers(97, 123, rng.integers(40, 160)).astype(np.uint8)).decode() for _ in range(6)]
    for _ in range(70):
        yield "".join(
            shared[rng.integers(0, 6)][rng.integers(0, 20) :] if rng.random() < 0.5 else bytes(rng.integers(97, 101, rng.integers(0, 90)).astype(np.uint8)).decode()
            for _ in range(rng.integers(0, 7))
        )
    yield "ab" * 200
    yield "é" * 150


@pytest.mark.parametrize("hot", [512, 2])
def test_repeats_equal_brute_force(spark, hot):
    rows = [t for t in passages(np.random.default_rng(hot))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    passage = suffixes.Passage(size=50, anchor=12, hot=hot, chunk=40)
    raw = [t.encode() for t in rows]
    expected = {}
    for n, (text, hit) in enumerate(zip(raw, covered(raw, 50, False))):
        starts = int((hit & ~np.concatenate(([False], hit[:-1]))).sum()) if len(hit) else 0
        expected[n] = (len(text), int(hit.sum()), starts, hashlib.sha256(bytes(np.frombuffer(text, np.uint8)[~hit])).hexdigest())
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeated_bytes(docs, passage).collect()}
    assert found == expected
    left = {r.doc_id: r.text for r in suffixes.without_repeats(docs, suffixes.Passage(size=50, anchor=12, hot=hot, chunk=40, keep_first=True)).collect()}
    for n, hit in enumerate(covered(raw, 50, True)):
        kept = bytes(np.frombuffer(raw[n], np.uint8)[~hit])
        assert left[n] == kept.decode() if raw[n].isascii() else left[n].isprintable()


def word_runs(text, hit, words):
    """Those of the covered runs that hold so many whole words."""
    out = np.zeros(len(text), dtype=bool)
    for run in re.finditer(rb"\x01+", hit.astype(np.uint8).tobytes()):
        inside = [w for w in re.finditer(rb"[^\x20\x09-\x0D]+", text) if w.start() >= run.start() and w.end() <= run.end()]
        out[run.start() : run.end()] = len(inside) >= words
    return out


def short_repeats(rows, words, size):
    places = collections.defaultdict(list)
    for n, text in enumerate(rows):
        found = list(re.finditer(rb"[^\x20\x09-\x0D]+", text))
        for first, last in zip(found, found[words - 1 :]):
            if last.end() - first.start() < size:
                places[text[first.start() : last.end()]].append((n, first.start(), last.end()))
    return [place for found in places.values() if len(found) > 1 for place in found]


@pytest.mark.parametrize("hot", [512, 2])
def test_two_lengths_equal_brute_force(spark, hot):
    """Strings of 50 bytes as without ``least``; in the text, passages of six words go too."""
    rng = np.random.default_rng(hot)
    draw = lambda n: " ".join(bytes(rng.integers(97, 123, rng.integers(1, 9)).astype(np.uint8)).decode() for _ in range(n))
    shared = [draw(rng.integers(4, 14)) for _ in range(12)] + ["pq " * 30, "é" * 40]
    # Many copies of one passage next to the end of a text, and whole copies.
    rows = ["".join(shared[rng.integers(0, 14)][rng.integers(0, 9) :] if rng.random() < 0.5 else draw(rng.integers(0, 9)) + " " for _ in range(rng.integers(0, 8))) for _ in range(70)]
    rows += [draw(4) + " " + shared[0] + draw(9)[: rng.integers(0, 40)] for _ in range(20)] + rows[:5] + ["", None]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    raw = [(t or "").encode() for t in rows]
    near, wanted = covered(raw, 24, False), covered(raw, 50, False)
    for n, a, b in short_repeats(raw, 6, 24):
        near[n][a:b] = True
    passage = suffixes.Passage(size=50, anchor=12, hot=hot, chunk=40, words=6, least=24)
    found = {r.doc_id: r for r in suffixes.repeated_bytes(docs, passage).collect()}
    plain = {r.doc_id: r for r in suffixes.repeated_bytes(docs, suffixes.Passage(size=50, anchor=12, hot=hot, chunk=40)).collect()}
    fewer = 0
    for n, (text, close, hit) in enumerate(zip(raw, near, wanted)):
        assert found[n].n_removed == int(hit.sum())
        assert found[n].kept_sha256 == hashlib.sha256(bytes(np.frombuffer(text, np.uint8)[~hit])).hexdigest()
        assert found[n][:4] == plain[n][:4] and found[n].n_spans == plain[n].n_spans
        cut = hit | word_runs(text, close, 6)
        kept = bytes(np.frombuffer(text, np.uint8)[~cut])
        assert found[n].text == kept.decode() if text.isascii() else abs(len(found[n].text.encode()) - len(kept)) < 20
        fewer += bool((cut & ~hit).any())
    assert fewer > 2


def test_op5_text_is_without_passages_of_over_50_words(spark, tmp_path):
    rng = np.random.default_rng(52)
    draw = lambda n, least=1, most=9: " ".join("".join(chr(c) for c in rng.integers(97, 123, rng.integers(least, most))) for _ in range(n))
    middle, tiny, few = draw(60, 4, 6), draw(51, 1, 4), draw(50, 5, 7)
    assert 250 <= len(middle) < 400 and len(tiny) < 250 <= len(few) < 400
    texts = [f"{draw(40)} {passage} {draw(40)}" for passage in (middle, tiny, few) for _ in range(2)] + [draw(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op5_suffix_array_dedup(spark, str(tmp_path)).collect()}
    # The contract counts strings of 400 bytes.
    assert all(r.n_removed == r.n_spans == 0 and r.kept_sha256 == hashlib.sha256(texts[i].encode()).hexdigest() for i, r in rows.items())
    for i, passage in enumerate((middle, middle, tiny, tiny)):
        # Letters beside it may be equal by chance.
        assert passage not in rows[i].text and 0 <= len(texts[i]) - len(passage) - len(rows[i].text) <= 6 and rows[i].n_cuts == 1
    assert [rows[i].text for i in (4, 5, 6)] == texts[4:] and all(rows[i].n_cuts == 0 for i in (4, 5, 6))


def test_repeats_on_odd_input(spark, odd, empty):
    rows = suffixes.repeated_bytes(odd).toPandas()
    assert len(rows) == len(odd_rows())
    size = {r[0]: len((r[1] or "").encode()) for r in odd_rows()}
    known = rows[rows.doc_id.notna()].drop_duplicates("doc_id").set_index("doc_id")
    assert (known.n_bytes == [size[i] for i in known.index]).all()
    assert known.n_removed[6] == size[6] and known.n_removed[7] == size[7] and known.n_removed[1] == 0
    assert known.n_removed[11] == 1800 and known.n_removed[12] == 3900
    assert suffixes.repeated_bytes(empty).count() == 0
    cut = suffixes.without_repeats(odd).toPandas()
    assert list(cut.columns) == odd.columns and cut.text.isna().sum() == 2
    cut = cut[cut.doc_id.notna()].drop_duplicates("doc_id").set_index("doc_id")
    assert len(cut.text[7]) < len(cut.text[6])


# 6 Preference formatting


def test_common_turns_are_the_prompt(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", None), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (2, 1, "assistant", "no"), (None, 0, "user", "x"), (3, None, "user", "x")]
    table = spark.createDataFrame([(*r, "q") for r in rows], "conv_id long, turn long, role string, text string, chosen string")
    turns = chat.turns_of(table)
    pairs = spark.createDataFrame([(1, 1, 2), (2, 2, 2), (3, 1, 99)], "pair_id long, chosen long, rejected long")
    out = {r.pair_id: r for r in chat.preference_rows(chat.pairs_of(turns, pairs)).collect()}
    assert out[1].n_prompt == 1 and out[1].prompt == "<|user|>\nhi\n"
    assert out[1].chosen == "<|assistant|>\nyes\n<|user|>\n\n" and out[1].rejected == "<|assistant|>\nno\n"
    assert out[1].chosen_mask == "14-17" and out[1].chosen[14:17] == "yes" and out[1].rejected_mask == "14-16"
    assert out[2].n_prompt == 2 and out[2].chosen == "" and out[2].rejected_mask == ""
    assert out[3].n_prompt == 0 and out[3].rejected == ""
    assert chat.preference_rows(chat.stale_replies(chat.turns_of(table.limit(0)))).count() == 0


# 7 Neighbours


def test_neighbours_recall_and_scores(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = neighbours.neighbours(table, index=neighbours.Index(rows=200, queries=10)).toPandas()
    data = {r.vec_id: np.array(r.embedding, dtype=float) for r in table.collect()}
    ids = np.array(sorted(data))
    x = np.stack([data[i] for i in ids])
    hits = 0
    for q in ids[ids % 20 == 0]:
        score = x @ data[q]
        best = [ids[i] for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        got = rows[rows.query_id == q].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, 21))
        assert np.allclose(got.score, [data[v] @ data[q] for v in got.vec_id], atol=1e-12) and (np.diff(got.score) <= 0).all()
        hits += len(set(best) & set(got.vec_id))
    assert hits >= 0.9 * 20 * (ids % 20 == 0).sum()


def test_pigeonhole_finds_every_code_within_the_radius():
    codes = np.random.default_rng(0).integers(0, 256, (500, 4)).astype(np.uint8)
    tables = neighbours.Tables(codes)
    for radius in (0, 3, 7, 11, 32):
        far = np.array([sum(bin(int(a ^ b)).count("1") for a, b in zip(c, codes[0])) for c in codes])
        assert tables.within(codes[0], radius).tolist() == np.flatnonzero(far <= radius).tolist()


def test_neighbours_on_odd_input(spark):
    rows = [(0, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (7, [-1.0, 0.5], 1), (7, [-1.0, 0.5], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    out = neighbours.neighbours(table).toPandas()
    zero = out[out.query_id == 0].sort_values("rank")
    assert zero.vec_id.tolist() == [1, 20, 7, 7] and zero.score.tolist() == [1.0, 1.0, -1.0, -1.0]
    assert neighbours.neighbours(table.limit(0)).count() == 0
    assert neighbours.neighbours(table.where("vec_id = 0")).count() == 0


# 8 Quality rules


def plain_stats(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = collections.Counter(windows)
    marked = {i + s for i, w in enumerate(windows) if count[w] > 1 for s in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked)


def test_rule_statistics_equal_brute_force(spark, documents, odd):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    for docs in (documents, odd):
        rows = rules.quality_rules(docs, labels).toPandas()
        want = collections.Counter()
        for r in docs.select("doc_id", "text").collect():
            stats = plain_stats(r.text or "")
            want[(r.doc_id, *stats, stats[0] < 50 or 100 * stats[4] > 50 * stats[0])] += 1
        ids = [None if math.isnan(i) else int(i) for i in rows.doc_id]
        assert collections.Counter(zip(ids, rows.n_words, rows.word_chars, rows.n_symbols, rows.n_dup_lines, rows.n_repeat_words, rows.base_failed)) == want
        assert not (rows.base_failed & rows.kept).any()


def test_forest_separates_labelled_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = rules.quality_rules(docs, labels.where("pmod(doc_id, 2) = 0")).join(labels.where("pmod(doc_id, 2) = 1"), "doc_id").where("NOT base_failed").toPandas()
    assert rows[rows.quality == 1].kept.mean() > 0.98 and (~rows[rows.quality == 0].kept).mean() > 0.9


def test_rules_without_labels_or_rows(odd, empty, labels):
    assert rules.quality_rules(odd, labels.limit(0)).count() == len(odd_rows())
    assert rules.quality_rules(empty, labels).count() == 0


def test_forest_and_threshold_see_all_rows(spark):
    """Counts of the trees add up to all documents, and of the cut to all labels, beyond any sample."""
    made = [(i, *((60, 300, 0, 0, 0, 6, 0, 0) if i % 10 else (60, 300, 30 + i % 7, 0, 0, 6, 0, 9))) for i in range(60_000)]
    stats = spark.createDataFrame(made, "doc_id long, " + ", ".join(f"{s} long" for s in rules.STATS))
    settings = rules.Forest(trees=20)
    forest = rules.grow(stats, settings)
    assert forest.size == 3_000  # of 60,000 documents dealt among 20 trees
    last = rules._nodes(stats.selectExpr(*rules.STATS, "pmod(doc_id, 20) AS deal"), forest, 1)
    assert sum(n for n, *_ in last.values()) == 60_000
    labels = spark.range(60_000).selectExpr("id AS doc_id", "if(id % 10 = 0, 0, 1) AS quality")
    _, cut = rules.fit(stats, labels, settings)
    scores = rules._scored(stats, forest).where(f"oddness > {cut}")
    assert scores.count() == 6_000 and scores.where("doc_id % 10 <> 0").count() == 0
    score, good, bad = np.array([0.1, 0.2, 0.3, 0.4]), np.array([996.0, 3, 1, 0]), np.array([1.0, 0, 5, 7])
    assert rules.threshold(score, good, bad, rules.Forest(keep_good=0.9985)) == pytest.approx(0.25)


# 10 Mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        rest = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in order if s not in capped)
        target = {s: float(most * sizes[s]) if s in capped else rest * weight[s] / open_ for s in order}
        above = {s for s in order if s not in capped and target[s] >= most * sizes[s]}
        if not above:
            return target
        capped |= above


def test_mix_meets_its_targets(spark, documents):
    tall = documents.unionByName(documents.limit(30).selectExpr("doc_id + 100000 AS doc_id", "text", "lang", "cast(null AS string) AS source", "n_chars"))
    rows = mixing.mixture(tall).join(tall.select("doc_id", "text", "source"), "doc_id").toPandas()
    assert (rows["size"] == [len(WORD.findall(t)) for t in rows.text]).all()
    rows["source"] = rows.source.where(rows.source.notna(), None)
    size = rows.groupby("source", dropna=False)["size"].sum()
    sizes = {None if isinstance(s, float) else s: int(n) for s, n in size.items()}
    target = plain_targets(sizes)
    assert set(rows.copies) <= {0, 1, 2, 3} and (rows.taken == rows.copies * rows["size"]).all()
    for source, part in rows.groupby("source", dropna=False):
        source = None if isinstance(source, float) else source
        assert (part.source_size == sizes[source]).all() and np.allclose(part.target, target[source], rtol=1e-12)
        assert abs(part.taken.sum() - target[source]) <= max(part["size"].min(), 0.02 * target[source])
    again = mixing.mixture(tall.repartition(5)).toPandas()
    assert dict(zip(again.doc_id, again.taken)) == dict(zip(rows.doc_id, rows.taken))


def test_rates_are_the_entropy_optimum(spark):
    """At the optimum log r is proportional to the size, wherever the cap does not bind."""
    rng = np.random.default_rng(0)
    rows = [("no", s, int(n), 5) for s in ("a", "b") for n in set(rng.integers(1, 900, 80).tolist())]
    cells = spark.createDataFrame([(False, s, n, d) for _, s, n, d in rows], "no_source boolean, source string, size long, docs long")
    mix = mixing.Mix()
    duals = {r.source: r for r in mixing.multipliers(cells, mixing.targets(cells, mix), mix).collect()}
    for source, d in duals.items():
        mine = [(n, k) for _, s, n, k in rows if s == source]
        mass = sum(n * k * min(3.0, math.exp(d.l * n / d["mean"])) for n, k in mine)
        assert abs(mass - d.target) <= 1e-6 * d.target


def test_mix_of_odd_input(odd, empty):
    rows = mixing.mixture(odd).toPandas()
    assert len(rows) == len(odd_rows())
    assert (rows.taken <= 3 * rows["size"]).all() and rows[rows["size"] == 0].taken.sum() == 0
    assert mixing.mixture(empty).count() == 0


# Queries


def test_every_operator_is_a_query():
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 11)} | {"pipeline"}


# Strings that fool sums modulo a power of two


def thue_morse(n, letters="ab"):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


def fooling(size=2048):
    """Two words of two letters, each the other's complement."""
    return thue_morse(size), thue_morse(size, "ba")


def test_hashes_tell_fooling_strings_apart():
    one, two = fooling()
    data, bounds = scan.text_buffer(pa.array([one, two]))
    quick = scan.Rolling(3)
    same = quick.of(quick.sums(data), bounds[:-1], bounds[1:])
    assert same[0] == same[1]  # why these strings are a test
    for seed in range(20):
        hasher = scan.Hasher(seed)
        found = hasher.of(hasher.sums(data), bounds[:-1], bounds[1:])
        assert found[0] != found[1]
    code, kinds = scan.coded(data, bounds[:-1], bounds[1:])
    assert code.tolist() == [0, 1] and len(set(scan.string_hashes(kinds).tolist())) == 2


def test_fooling_strings_keep_their_ids(spark):
    """Packing and token output give each text its own ids, though their pieces look alike to a weak hash."""
    texts = [f"{w} {w}" for w in fooling()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    encoder = tokens.encoder(tokens.default_path()).tokenizer
    ids = {i: [*encoder.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    crc = lambda part: zlib.crc32(np.array(part, dtype="<u4").tobytes())
    written = grammar.decode(grammar.write_blocks(docs, tokens.default_path())).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in written} == {i: (len(x), crc(x)) for i, x in ids.items()}
    for r in packing.packed_documents(docs, tokens.default_path()).collect():
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])


def test_fooling_lines_and_passages_do_not_repeat(spark, labels):
    one, two = fooling()
    docs = spark.createDataFrame([(1, f"{one}\n{two}"), (2, f"{one}\n{one}")], "doc_id long, text string")
    assert {r.doc_id: r.n_dup_lines for r in rules.quality_rules(docs, labels.limit(0)).collect()} == {1: 0, 2: 1}
    # The words repeat in themselves; what repeats nowhere are 2,000 bytes.
    far = suffixes.repeated_bytes(spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string"), suffixes.Passage(size=2000, hot=1))
    assert [r.n_removed for r in far.collect()] == [0, 0]


def test_contexts_of_a_busy_anchor_give_ranges_not_windows(spark):
    """Texts that share one passage with unlike neighbours: as many rows below ``hot`` as above."""
    rng = np.random.default_rng(4)
    passage = "".join(map(chr, rng.integers(97, 123, 300)))
    rows = [(i, "".join(map(chr, rng.integers(97, 123, 200))) + passage + "".join(map(chr, rng.integers(97, 123, 200)))) for i in range(120)]
    docs = suffixes.keyed(spark.createDataFrame(rows, "doc_id long, text string"))
    counts = {}
    for hot in (16, 4096):
        found = suffixes.spans(docs, suffixes.Passage(size=100, anchor=16, hot=hot, keep_first=True)).toPandas()
        counts[hot] = len(found), sum(len(a) for a in found.a)
    assert counts[16][0] <= 1.2 * counts[4096][0] and counts[16][1] <= 1.5 * counts[4096][1]


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=2 if i % 3 else 1).tolist()) for i in range(90)]
    found = neighbours.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=20).toPandas()
    vectors = dict(rows)
    for query in range(0, 90, 20):
        alike = [i for i in vectors if i != query and len(vectors[i]) == len(vectors[query])]
        best = sorted(alike, key=lambda i: (-np.dot(vectors[i], vectors[query]), i))[:20]
        mine = found[found.query_id == query].sort_values("rank")
        assert mine.vec_id.tolist() == best


# The models against their definitions, step by step


def slow_probabilities(model, text):
    """Label probabilities of every byte of a window, one state after the other."""
    w = {n: v.astype(float) for n, v in model.weights.items()}
    h, out = model.net.hidden, []

    def states(d, order):
        s, found = np.zeros(h), {}
        for t in order:
            given, a = w[f"w{d}"][:, text[t]], w[f"u{d}"] @ s
            z, r = (np.clip((given[i * h : (i + 1) * h] + a[i * h : (i + 1) * h]) / 4 + 0.5, 0, 1) for i in range(2))
            n = np.clip(given[2 * h :] + r * a[2 * h :], -1, 1)
            s = n + z * (s - n)
            found[t] = s
        return found

    ahead, behind = states("f", range(len(text))), states("b", range(len(text) - 1, -1, -1))
    for t in range(len(text)):
        p = np.exp(w["vf"] @ ahead[t] + w["vb"] @ behind[t] + w["c"][:, 0])
        out.append(p / p.sum())
    return np.array(out)


def test_pooled_probabilities_equal_a_slow_network():
    model = language.BiGru(["a", "b", "c"], language.Net(hidden=5, window=16))
    texts = ["", "a", "Ein Satz mit über sechzehn Bytes, in drei Fenstern", "x" * 16, "ñandú\n"]
    data, bounds = scan.text_buffer(pa.array(texts))
    found = language.document_sums(model, data, bounds, size=3)
    for text, sums in zip(texts, found):
        raw = text.encode()
        pieces = [slow_probabilities(model, raw[i : i + 16]).sum(axis=0) for i in range(0, len(raw), 16)]
        np.testing.assert_allclose(sums, np.sum(pieces, axis=0) if pieces else np.zeros(3), atol=1e-4)


def test_posteriors_equal_the_moments_of_sites(spark, documents, labels):
    docs = documents.withColumn("source", F.concat("source", F.lit("/"), F.col("doc_id") % 3))
    known = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = quality.classified(docs, known).toPandas()
    paths = rows.groupby(["host", "path"]).p_doc.agg(["sum", "count"]).reset_index()
    hosts = paths.groupby("host")[["sum", "count"]].sum()
    rate = hosts["sum"].sum() / hosts["count"].sum()

    def strength(p, n, centre):
        between, noise = (n * (p / n - centre) ** 2).sum(), (centre * (1 - centre) * np.ones(len(n))).sum()
        spread = (n * centre * (1 - centre)).sum()
        return np.clip(spread / n.sum() / max((between - noise) / n.sum(), 1e-9) - 1, 1, 1e6)

    k_host = strength(hosts["sum"], hosts["count"], rate)
    host_rate = (k_host * rate + hosts["sum"]) / (k_host + hosts["count"])
    paths["host_rate"] = paths.host.map(host_rate)
    k_path = strength(paths["sum"], paths["count"], paths.host_rate)
    joined = rows.merge(paths, on=["host", "path"])
    site = ((k_path * joined.host_rate + joined["sum"] - joined.p_doc) / (k_path + joined["count"] - 1)).clip(1e-6, 1 - 1e-6)
    logit = lambda p: np.log(p / (1 - p))
    odds = logit(joined.p_doc) - logit(rate) + logit(site)
    np.testing.assert_allclose(joined.site_rate, site, rtol=1e-6)
    np.testing.assert_allclose(joined.p_bad, 1 / (1 + np.exp(-odds)), rtol=1e-5, atol=1e-9)
