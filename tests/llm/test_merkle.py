"""The manifest against one computed row by row, and the sharing of nodes between versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from opinarium.llm import merkle
from opinarium.llm.queries import ORACLES, QUERIES
from tests.comparison import differences, duck

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def by_hand(rows):
    if not rows:
        return []
    langs = {}
    for row in rows:
        langs.setdefault(row[2], []).append(row)
    order = sorted(langs, key=lambda k: (k is not None, (k or "").encode()))
    for own in langs.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {k: levels_over([leaf_of(r) for r in langs[k]]) for k in order}
    upper = levels_over([trees[k][-1][0] for k in order])
    root, out = upper[-1][0], []
    for place_of_lang, lang in enumerate(order):
        for place_of_row, row in enumerate(langs[lang]):
            top, siblings = leaf_of(row), []
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                top = leaf_of((*row[:3], row[3] + 1, row[4]))
            for tree, place in ((trees[lang], place_of_row), (upper, place_of_lang)):
                for level in tree[:-1]:
                    other = level[place ^ 1] if place ^ 1 < len(level) else ""
                    siblings.append(other)
                    top = digest(other, top) if place & 1 else digest(top, other)
                    place >>= 1
            out.append((row[0], leaf_of(row), trees[lang][-1][0], root, digest(*siblings), top, top == root))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted((tuple(r)[:7] for r in merkle.verified_manifest(frame, **options).collect()), key=repr)


def dirty_rows():
    rng = random.Random(5)
    rows = [(rng.choice([None, i, i, i // 3]), rng.choice(["s", None]), rng.choice(["en"] * 6 + ["de", None, "", "é"]),
             rng.choice([None, i]), rng.choice(["", None, "é text\n" * 3, "x" * 200_000])) for i in range(150)]
    return rows + rows[:30]


@pytest.mark.parametrize("rows,bits", [
    ([], 10), ([(1, None, None, None, None)], 10), (dirty_rows(), 2), (dirty_rows(), 10),
    ([(i, "a", "en" if i % 3 else "fr", 3, "x") for i in range(1100)], 4)])
def test_equals_the_manifest_by_hand(spark, rows, bits):
    assert found(spark, rows, bits=bits) == by_hand(rows)


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert differences(QUERIES["op13_merkle"](spark, sf), duck(sf), ORACLES["op13_merkle"]) == []


def test_further_columns_do_not_clash(spark):
    names = ("digest", "index", "total", "group", "leaf", "path", "subroot", "changed", "_read", "_range", "_at")
    rows = [(i, "a", "en", 3, "x") for i in range(9)]
    frame = spark.createDataFrame([(*r, *["y"] * len(names)) for r in rows],
                                  SCHEMA + "".join(f", {n} string" for n in names))
    got = sorted((tuple(r)[:7] for r in merkle.verified_manifest(frame).collect()), key=repr)
    assert got == by_hand(rows)


def test_a_version_copies_one_path_and_shares_the_rest():
    leaves = [digest(str(i)) for i in range(11)]
    tree = merkle.PersistentBlock(leaves, 4)
    before = [list(level) for level in tree.levels]
    for place in range(11):
        copies = merkle.copied(digest("new"), tree.shared(place))
        changed = leaves[:place] + [digest("new")] + leaves[place + 1:]
        again = merkle.PersistentBlock(changed, 4)
        assert copies[-1] == again.top
        own = {n for level in again.levels for n in level} - {n for level in tree.levels for n in level}
        assert own == {digest("new"), *copies}
    assert tree.levels == before


def test_tampering_is_found(spark):
    rows = [(i, "a", "en", 3, "x") for i in range(60)]
    hit = {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0}
    out = merkle.verified_manifest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"] for r in out if not r["verified"]} == hit
    assert all((r["copied_nodes"] == 7) == (r["doc_id"] in hit) for r in out)
