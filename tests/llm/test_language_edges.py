"""Pages with unclosed marks, many declared languages, short texts, and fusion by brute force."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import pytest

from opinarium.llm import langid

_MARKS = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.DOTALL | re.IGNORECASE)
TEXTS = {"de": "der hund und die katze sind in dem haus", "en": "the dog and the cat are in this house"}


def test_shown_texts_equal_those_of_a_pattern():
    signs = [b"<script", b"<style>", b"</script>", b"</STYLE >", b"<!--", b"-->", b"<p>", b"x", b"<", b">", b" ", b"-"]
    choose = random.Random(3)
    for _ in range(20000):
        page = b"".join(choose.choice(signs) for _ in range(choose.randint(0, 12)))
        assert langid._shown(page) == _MARKS.sub(b" ", page)


@pytest.mark.parametrize("mark", [b"<script ", b"<!--", b"<style>", b"<", b"<script></script "])
def test_two_megabytes_of_unclosed_marks(mark):
    start = time.perf_counter()
    langid._shown(mark * (2_000_000 // len(mark)))
    assert time.perf_counter() - start < 2


def test_many_declared_languages_give_a_result_for_every_row(spark):
    rows = [(i, f"word{i} " + TEXTS["de"], f"x{i:04d}", "s") for i in range(2000)]
    rows += [(2000 + i, f"{TEXTS[k]} {k}{i}", k, "s") for i in range(40) for k in TEXTS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    profiles = langid.train(docs)
    assert len(profiles.languages) == langid.MOST_LANGUAGES and {"de", "en"} <= set(profiles.languages)
    assert langid.document_languages(docs, profiles).count() == len(rows)


def test_short_texts_with_letters_stay(spark):
    rows = [(i, f"{TEXTS[k]} {k}{i}", k, "s") for i in range(40) for k in TEXTS]
    short = ["no", "OK", "a b c d e", "Привет мир", "你好 世界"]
    none = ["", None, "12 34 !!", "   "]
    rows += [(1000 + i, t, None, None) for i, t in enumerate(short + none)]
    rows += [(2000, "qzx jkv wqz xvk zzq " * 30, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in langid.readable_documents(docs, langid.train(docs)).collect()}
    assert kept == {r[0] for r in rows} - {1005, 1006, 1007, 1008, 2000}


def test_fusion_by_brute_force(spark):
    languages = ["a", "b", "c"]
    choose = random.Random(8)
    rows = [(i, choose.choice(["h1", "h2", "h3", None]), choose.choice(["x", "y"]), choose.choice(["a", "b", "", None]),
             choose.choice([0, 5, 200]), True, [choose.uniform(-3, 9) for _ in languages]) for i in range(300)]
    found = spark.createDataFrame(rows, "id int, host string, suffix string, declared string, sequences long, "
                                        "letters boolean, ll array<double>")
    got = {r["id"]: r for r in langid.fuse(found, languages).collect()}
    own = {r[0]: max(range(3), key=lambda k: (r[6][k], -k)) for r in rows if r[4] > 0 and max(r[6]) > 0}
    overall, hosts, suffixes, declared = Counter(), Counter(), Counter(), Counter()
    for r in rows:
        if r[0] in own:
            k = own[r[0]]
            overall[k] += 1
            hosts[r[1], r[2], k] += 1
            suffixes[r[2], k] += 1
            declared[r[3], k] += 1
    total = sum(overall.values())
    values = len({d for d, _ in declared})

    def share(counts, key, above):
        n = [counts[*key, k] for k in range(3)]
        return [(n[k] + 20 * above[k]) / (sum(n) + 20) for k in range(3)]

    base = [(overall[k] + 1) / (total + 3) for k in range(3)]
    for i, host, suffix, told, sequences, _, ll in rows:
        if i not in own:
            assert (got[i]["text_lang"], got[i]["lang"], got[i]["probability"]) == ("und", "und", 0.0)
            continue
        prior = share(hosts, (host, suffix), share(suffixes, (suffix,), base))
        logs = [math.log(prior[k]) + math.log((declared[told, k] + 1) / (overall[k] + values + 1))
                + ll[k] * min(1, 60 / sequences) for k in range(3)]
        best = max(range(3), key=lambda k: logs[k])
        assert (got[i]["text_lang"], got[i]["lang"]) == (languages[own[i]], languages[best])
        assert got[i]["probability"] == pytest.approx(1 / sum(math.exp(x - logs[best]) for x in logs))


def test_pages_with_nulls_repeats_and_none(spark):
    page = f'<html lang="de"><p>{TEXTS["de"]}</p></html>'
    rows = [(1, "http://a.de/x", page), (1, "http://a.de/x", page), (2, None, page), (3, "http://a.de/", None), (None, None, None),
            (4, "no address", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    known = spark.createDataFrame([(f"{t} {i}", k) for k, t in TEXTS.items() for i in range(30)], "text string, lang string")
    profiles = langid.train(known)
    found = sorted((r["page_id"] or 0, r["lang"], r["kept"]) for r in langid.page_languages(pages, profiles).collect())
    assert found == [(0, "und", False), (1, "de", True), (1, "de", True), (2, "de", True), (3, "und", False), (4, "und", False)]
    assert langid.page_languages(pages.limit(0), profiles).count() == 0
