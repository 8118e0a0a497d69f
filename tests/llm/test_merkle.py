"""The manifest against a plain Merkle tree, on given and odd documents."""

import hashlib
import zlib

import pytest

from tallyguard.llm import merkle

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, node string, tree int, place int, up int, before string"


def joined(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row):
    return joined(*[encoded(row[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")])


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([joined(*low[i : i + 8]) for i in range(0, len(low), 8)])
    return levels


def path(levels, i):
    for low in levels[:-1]:
        a = i // 8 * 8
        yield low[a:i], low[i + 1 : a + 8]
        i //= 8


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows):
    by = {}
    for row in rows:
        by.setdefault(row["lang"], []).append(row)
    order = sorted(by, key=lambda name: (name is not None, (name or "").encode()))
    for name in order:
        by[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {name: tree([leaf(r) for r in by[name]]) for name in order}
    top = tree([trees[name][-1][0] for name in order]) if order else [[None]]
    for n, name in enumerate(order):
        for i, row in enumerate(by[name]):
            steps = [*path(trees[name], i), *path(top, n)]
            doc_id, folded = row["doc_id"], leaf(row)
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and row["text"] is not None:
                folded = leaf({**row, "text": lower(row["text"])})
            for before, after in steps:
                folded = joined(*before, folded, *after)
            proof = joined(*[d for before, after in steps for d in before + after])
            yield doc_id, leaf(row), trees[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]


def check(docs):
    found = [tuple(r) for r in merkle.checked_manifest(docs).collect()]
    wanted = list(expected([r.asDict() for r in docs.collect()]))
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    return found


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "n", 1, 2, 3, "b") for r in rows], DOCS)


def test_given_documents(spark):
    found = check(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert 0 < sum(not r[-1] for r in found) < len(found)


def test_odd_rows(spark):
    """Nulls in any field, empty and long texts, repeated rows and ids, several heights of trees."""
    rows = [
        (1, "Text", "en", "a"), (2, None, "en", None), (3, "", None, "a"), (None, "No id", None, None), (None, None, None, None),
        (None, None, None, None), (5, "ABC" * 50_000, "xx", "a"), (6, "same", "de", "a"), (6, "same", "de", "a"), (6, "Other", "de", "ü"),
        (-9, "Ä:B", "zz", "1:a"),
    ]
    check(frame(spark, rows + [(i, f"Row {i}", "fr", "b") for i in range(10, 83)]))


@pytest.mark.parametrize("rows", [[(3, "Alone", "en", "a")], [(i, "Two", lang, None) for i, lang in enumerate(("en", "de"))], []])
def test_few_rows(spark, rows):
    assert len(check(frame(spark, rows))) == len(rows)


def test_a_change_of_any_field_shows(spark):
    rows = [(i, f"text {i}", "en", "s") for i in range(20)]
    roots = {merkle.manifest(frame(spark, changed)).first().root for changed in (
        rows, [*rows[:7], (7, "text 7.", "en", "s"), *rows[8:]], [*rows[:7], (7, "text 7", "en", None), *rows[8:]], rows[1:])}
    assert len(roots) == 4
    assert merkle.manifest(frame(spark, rows)).where("NOT verified").count() == 0
