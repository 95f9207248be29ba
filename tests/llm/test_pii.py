"""Personal data against regular expressions, and the discovery of unseen identifiers."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from opinarium.llm import pii
from opinarium.llm.arrays import block_of

PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]
CARD = "4539 1488 0343 6467"


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return (kind == 0 or kind == 1 and all(int(p) <= 255 for p in match.split("."))
            or kind == 2 and 16 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 8 <= len(digits) <= 15)


def by_hand(text):
    return [(k, m.start(), m.end()) for k, r in enumerate(PATTERNS) for m in r.finditer(text or "") if valid(k, m[0])]


def listed(found):
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in found)


def in_block(texts):
    block = block_of(texts)
    found = pii.base_spans(block)
    rows = block.rows_of(found.start)
    out = [[] for _ in texts]
    for r, k, a, b in zip(rows, found.kind, *(pii._code_points(block, x, rows) for x in (found.start, found.end))):
        out[r].append((int(k), int(a), int(b)))
    return [sorted(x) for x in out]


@pytest.mark.parametrize("letters", ["0123456789" * 2 + "..@@++-- ()a%é\n_,:Z", "0123456789" * 3 + " -+.", "12.", "a@.-"])
def test_base_spans_equal_the_expressions(letters):
    rng = random.Random(letters)
    fixed = ["256.1.1.1", "0001.2.3.04", "a@b.c@d.e.", "+1 2 3 4 5 6 7 8-", CARD, "1.2.3.4.5.6.7.8", "é +49 30 1234-567 "]
    for _ in range(400):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) + rng.choice(["", *fixed])
                 for _ in range(rng.randrange(1, 8))]
        assert in_block(texts) == [sorted(by_hand(t)) for t in texts]


def test_long_texts_take_linear_time():
    start = time.perf_counter()
    for text in ("a" * 500_000, "a@" * 200_000, "1." * 200_000, "+1" * 200_000, "1 " * 200_000):
        block = block_of([text])
        pii.Words(block, pii.base_spans(block)).candidates(block)
    assert time.perf_counter() - start < 30


SCHEMA = "doc_id long, text string"


def found(spark, rows):
    return [tuple(r) for r in pii.personal_data(spark.createDataFrame(rows, SCHEMA)).collect()]


def contact_texts():
    """Addresses and numbers behind labels, an unlabelled word in the same place now and then, and
    identifiers of no plain pattern in the same contexts."""
    rng = random.Random(4)
    filler = "the of and house river green walked slowly because nothing ever".split()

    def words(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    rows = [f"{words(8)} Contact ID: user{i}@mail{i}.example.com {words(6)}" for i in range(12)]
    rows += [f"{words(5)} reach me at +49 30 {1000000 + 7919 * i} please {words(4)}" for i in range(8)]
    rows += [f"{words(4)} the of {i}.1.2.3 and" for i in range(5)]
    rows += [f"{words(30)} of the river and the of house" for _ in range(40)]
    unseen = [f"{words(7)} Contact ID: AB-99{i}17-X {words(3)}" for i in range(3)]
    plain = [f"{words(7)} order 2024-{i}99 {words(3)} the of build1234{i} and" for i in range(3)]
    again = f"so AB-99017-X it is {words(3)}"
    return rows, unseen, plain, again


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    rows, unseen, plain, again = contact_texts()
    texts = [*rows, *unseen, *plain, again]
    out = {r[0]: r for r in found(spark, list(enumerate(texts)))}
    for i, text in enumerate(texts):
        spans = by_hand(text)
        assert out[i][6] == hashlib.sha256(listed(spans).encode()).hexdigest()
        more = [(4, m.start(), m.end()) for m in re.finditer(r"AB-99\d17-X", text)]
        assert out[i][7] == listed(spans + more)
        assert out[i][1:6] == tuple(sum(s[0] == k for s in spans + more) for k in range(5))


def test_edges(spark):
    texts = [None, "", " ", f"card {CARD}", f"card {CARD}", "x " * 100_000 + " a@b.cd", "no data"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "9.9.9.9"), (None, "9.9.9.9"), (3, texts[3])]
    expected = sorted(((i, listed(by_hand(t)), hashlib.sha256(listed(by_hand(t)).encode()).hexdigest()) for i, t in rows), key=repr)
    assert sorted(((r[0], r[7], r[6]) for r in found(spark, rows)), key=repr) == expected
    assert found(spark, []) == []
    frame = spark.createDataFrame([(1, "9.9.9.9", 5, "p", 1)], SCHEMA + ", row int, places string, instance int")
    assert pii.personal_data(frame).select("spans").first()[0] == "ip:0:7"


def test_common_words_prove_nothing(spark):
    """Many seeds behind a common pair of words do not make a pattern of it."""
    rows = [(i, f"in the {i}.1.1.1 now") for i in range(20)] + [(99, "in the v1234567 now")]
    rows += [(100 + i, "in the house now " * 20) for i in range(10)]
    assert all(r[5] == 0 for r in found(spark, rows))
    without = [r for r in rows if r[0] < 100]
    assert sum(r[5] for r in found(spark, without)) == 1
