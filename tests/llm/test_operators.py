"""Operators against brute force, reference libraries and held-out labels on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_file
from opinarium.llm import arrays, bpe, components, licenses, near_dedup, packing, queries, secrets, sharding, toxicity
from tests.comparison import differences, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def library():
    ranks = bpe.encoder(queries.ranks_path()).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_exact_dedup_equals_sql(spark):
    sql = entry_file.oracle_sql()["op8_exact_dedup"]
    assert differences(queries.group_copies(spark, SF), duck(SF), sql) == []


def test_encoding_equals_the_library(spark, texts, library):
    for row in queries.encode_documents(spark, SF).collect():
        ids = np.array(library.encode_ordinary(texts[row["doc_id"]]), dtype="<u4")
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


def test_pieces_of_odd_texts(library):
    signs = list("ab's tremdl've  \n\t19é!?中\u0085\U0001f600\x1c'") + ["'ll", "'re", "<|endoftext|>", "x" * 60]
    choose = random.Random(5)
    made = ["".join(choose.choice(signs) for _ in range(choose.randint(0, 30))) for _ in range(3000)]
    code = bpe.encoder(queries.ranks_path())
    for block in arrays.blocks(pa.array(made)):
        ids, bounds = code.encode(block)
        for i in range(len(block)):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode_ordinary(made[block.first + i])


def test_encode_and_decode_round_trip(spark):
    docs = spark.createDataFrame([(1, "it's é round trip"), (2, None)], "doc_id long, text string")
    coded = bpe.encode_texts(docs, queries.ranks_path(), ["doc_id"])
    assert coded.first()["offsets"][0] == 0
    back = {r["doc_id"]: r["text"] for r in bpe.decode_ids(coded, queries.ranks_path(), ["doc_id"]).collect()}
    assert back == {1: "it's é round trip", 2: ""}


def test_packing(spark, texts, library):
    rows = queries.pack(spark, SF).collect()
    pieces, places = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids, at = [*library.encode_ordinary(text), 0], 0
        for k, r in enumerate(sorted(pieces[doc_id], key=lambda r: r["piece"])):
            own = np.array(ids[at:at + r["length"]], dtype="<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(own))
            assert k == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids)
    for sequence in places.values():
        at = 0
        for offset, length in sorted(sequence):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-sum(r["length"] for r in rows) // 2048) * 1.01 + 1


def test_packed_ids_equal_those_of_the_tokenizers_library(spark):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made = ["", "plain text", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>é", "x<|endoftext|", "it's  I'LL"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in packing.pack_documents(docs, queries.ranks_path()).collect()}
    for i, text in enumerate(made):
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        assert (rows[i]["length"], rows[i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


@pytest.mark.parametrize("lengths, step", [
    ([26, 33, 24, 49, 27, 32], (1, 1)), ([41, 24, 27, 29, 44, 63, 35, 17, 16], (1, 2)),
    ([19, 32, 50, 70, 19, 61, 19, 16], (2, 1)), ([17, 41, 48, 69, 17, 33, 22, 17, 20], (1, 0))])
def test_local_search_empties_a_sequence(lengths, step):
    """Best fit needs one sequence more; the steps of the search include an exchange of this kind."""
    packing_ = packing.Packing(np.array(lengths), 100)
    packing_.best_fit()
    used, steps, exchange = len(packing_.fill), [], packing_._exchange
    packing_._exchange = lambda a, out, b, back: (steps.append((len(out), len(back))), exchange(a, out, b, back))
    packing_.local_search()
    assert step in steps
    assert sum(1 for f in packing_.fill if f) == used - 1 == -(-sum(lengths) // 100)
    sequence, offset = packing_.places()
    for s in range(used - 1):
        inside = sorted((offset[i], lengths[i]) for i in np.flatnonzero(sequence == s))
        assert [at for at, _ in inside] == [sum(n for _, n in inside[:k]) for k in range(len(inside))]
        assert sum(n for _, n in inside) <= 100


def test_licenses_by_brute_force(spark, texts):
    for row in queries.scan_licenses(spark, SF).collect():
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), texts[row["doc_id"]])
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        places = sorted((i, label) for phrase, label in licenses.BASE.items()
                        for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split())
        assert (row["n_words"], row["n_base"]) == (len(words), len(places))
        assert row["first_word"] == (places[0][0] if places else None)
        assert row["last_word"] == (places[-1][0] if places else None)
        assert row["base_labels"] == ",".join(sorted({p[1] for p in places}))


@pytest.mark.parametrize("text,label", [
    ("a b", "x"), ("a z b c", "x"), ("a z z b", "x"), ("a z z z b", None), ("a b d", "x"), ("b a", None)])
def test_template_regions(text, label):
    scanner = licenses.Scanner({}, {"x": "a <<var;words=2>> b <<beginOptional>>c<<endOptional>>"})
    assert [m[2].label for m in scanner.scan(arrays.block_of([text]))[1][0]] == ([label] if label else [])


def test_neighbours_recall(spark):
    rows = queries.table(spark, SF, "embeddings").select("vec_id", "embedding").collect()
    ids = np.array([r["vec_id"] for r in rows])
    unit = np.array([r["embedding"] for r in rows], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    found = {}
    for r in queries.search_neighbours(spark, SF).collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = 0
    for i in np.flatnonzero(ids % 50 == 0):
        cosine = unit @ unit[i]
        cosine[i] = -2
        hits += len(set(ids[np.lexsort((ids, -cosine))[:5]]) & set(found[ids[i]]))
        assert len(found[ids[i]]) == 5
    assert hits >= 0.9 * 5 * len(found)


def test_shards(spark):
    rows = queries.shard(spark, SF).collect()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_ranges_move_clockwise_and_little():
    choose = random.Random(1)
    counts = {point: choose.randint(0, 400) for point, _ in sharding.ring(17)}

    def owners(shards):
        arcs = {p: 0 for p, _ in sharding.ring(shards)}
        points = sorted(arcs)
        for point, n in counts.items():
            arcs[next((p for p in points if p >= point), points[0])] += n
        return sharding.arc_ranges(arcs, shards)

    for shards in (1, 16, 17):
        sizes = [0] * shards
        for _, low, high, shard, _ in owners(shards):
            sizes[shard] += high - low
        assert sum(sizes) == sum(counts.values()) and max(sizes) - min(sizes) <= 1


def test_repeated_rows_fill_many_slots(spark):
    docs = spark.createDataFrame([(1, "x")] * 9000 + [(i, "y") for i in range(100)], "doc_id long, text string")
    out = sharding.shard_documents(docs, 4).groupBy("shard").agg(F.count("*"), F.max("slot"), F.countDistinct("slot"))
    assert sorted(tuple(r)[1:] for r in out.collect()) == [(2275, 2274, 2275)] * 4


def _near_by_brute_force(texts, words):
    sets = {}
    for k, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        sets[k] = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    have = {}
    for k, own in sets.items():
        for s in own:
            have.setdefault(s, []).append(k)
    for a, b in {(a, b) for ks in have.values() for a in ks for b in ks if a < b}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: (len(sets[k]), find(k)) for k in sets}


@pytest.mark.parametrize("pairs", [near_dedup.PAIRS_OF_BUCKET, 0])
def test_near_groups_by_brute_force(spark, monkeypatch, pairs):
    """A family in which many copies differ too much from each other, compared in both ways."""
    monkeypatch.setattr(near_dedup, "PAIRS_OF_BUCKET", pairs)
    choose = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = {0: "", 1: "too short", 2: "TOO short", 3: " ".join(base)}
    for k in range(4, 90):
        words = list(base)
        for _ in range(choose.randint(0, 9)):
            words[choose.randrange(150)] = f"v{choose.randrange(10_000)}"
        texts[k] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_groups(docs, 4).collect()}
    assert found == _near_by_brute_force(texts, 4)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 100), (7, 7), (95, 90)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90}


def test_secrets_by_brute_force(spark, texts):
    assign = re.compile(secrets._ASSIGN, re.ASCII | re.IGNORECASE)
    for row in queries.scan_secrets(spark, SF).collect():
        text = texts[row["doc_id"]]
        found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(filter(None, listed.split(","))) <= set(row["spans"].split(","))


def test_novel_strings_are_found_and_identifiers_are_not():
    key = "9fQ2vLx8Zr1TnB7kW0pYc3"
    for text, found in ((f"bearer {key}", [key]), ("secret is authorization_authentication_2 here", []),
                        (f"{key} without context", []), (f"access key AAAA0000{'0' * 20}", [])):
        assert [text[a:b] for a, b, _ in secrets.novel_spans(text)] == found


def test_redacted(spark):
    docs = spark.createDataFrame([(1, "é password=abcdef12 end", 22), (2, "clean", 5)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in secrets.redacted(docs).collect()] == [(1, "é [secret] end", 14), (2, "clean", 5)]


def test_swaps_do_not_move_scores():
    """Names that only toxic training texts mention weigh nothing once they are swapped."""
    table = np.array([[1, 1, 0], [1, 1, 0], [0, 0, 0], [0, 0, 1]] * 20, dtype=np.float32)
    label = np.array([1, 1, 0, 0] * 20, dtype=np.float32)
    swaps = np.array([[0, 0, 0], [0, 1, -1], [0, -1, 1]], dtype=float)
    plain, _ = toxicity.fit(table, label, swaps, swap_penalty=0.0)
    fair, _ = toxicity.fit(table, label, swaps, swap_penalty=5.0)
    assert abs(fair[1] - fair[2]) < 0.2 * abs(plain[1] - plain[2]) and fair[0] > 1


def test_held_out_toxicity(spark):
    labels = queries.table(spark, SF, "labels")
    rows = queries.score_toxicity(spark, SF).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) >= 0.9


def test_languages(spark):
    rows = queries.identify_languages(spark, SF).join(queries.table(spark, SF, "pages"), "page_id").collect()
    assert np.mean([r["lang"] == re.search(r"//[^/]+/(\w\w)/", r["url"])[1] for r in rows]) >= 0.98


def test_pipeline_packs_what_the_stages_keep(spark):
    rows = queries.run_pipeline(spark, SF).collect()
    kept = {r["doc_id"] for r in rows}
    copies = {r["doc_id"] for r in queries.group_copies(spark, SF).filter("kept").collect()}
    assert kept <= copies and len(kept) > 0.9 * len(copies)
