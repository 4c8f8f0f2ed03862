"""Exact, near and line deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cuesheet.llm import common, components, exact_dedup, line_dedup, simhash

from llm_cases import COLUMNS, odd_rows, rows_of, sentence


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_exact(rows, keep=max):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[lowered(text)].append(doc)
    out = []
    for text, docs in groups.items():
        known = [x for x in docs if x is not None]
        best = keep(known) if known else None
        taken = False
        for doc in docs:
            kept = doc == best and not taken
            taken |= kept
            out.append((doc, best, len(docs), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("key_bytes", [32, 1])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_groups(spark, clashing, key_bytes, keep):
    # With one byte of digest different texts collide, and the comparison of bytes must part them.
    got = exact_dedup.exact_groups(clashing, keep, key_bytes)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact([x[:2] for x in odd_rows()], max if keep == "largest" else min)


def test_exact_collisions_are_met(spark, odd):
    rows = exact_dedup.signed(odd, 1)
    assert rows.select("key").distinct().count() < rows.select("sha").distinct().count()


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_runs_are_merged_and_asked(spark, keep):
    rng = random.Random(3)
    index = exact_dedup.MergeIndex(keep, fanout=2)
    all_rows = []
    for batch in range(6):
        own = [(rng.choice([None, rng.randrange(50)]), bytes([rng.randrange(40)]), 1000 * batch + i) for i in range(60)]
        all_rows += own
        index.add(spark.createDataFrame(own, "doc_id long, key binary, entry_id long").repartition(3))
        assert len(index.runs) <= 2
    best = max if keep == "largest" else min
    want = {}
    for doc, key, entry in all_rows:
        want.setdefault(key, []).append((doc, entry))
    keys = spark.createDataFrame([(bytes([i]),) for i in range(60)], "key binary")
    got = {bytes(x["key"]): (x["keep_id"], x["keep_entry"], x["n"]) for x in index.find(keys).collect()}
    for key, own in want.items():
        known = [x for x in own if x[0] is not None] or [(0, x[1]) for x in own]
        doc, entry = best(known)
        assert got.pop(key) == (doc if any(x[0] is not None for x in own) else None, entry, len(own))
    assert not got
    assert len(index.runs) > 1
    found = {bytes(x["key"]): x["n"] for x in index.repeated().collect()}
    assert found == {key: len(own) for key, own in want.items() if len(own) > 1}
    assert exact_dedup.MergeIndex().find(keys).count() == 0


def test_runs_meet_in_lookups(spark):
    """Rows in many splits, most digests once: those that another run has are found, whether or not runs were merged."""
    docs = spark.range(0, 3000, 1, 12).selectExpr("id as doc_id", "cast(if(id % 10 = 0, id % 700, id) as string) as text")
    want = sorted(map(tuple, exact_dedup.exact_groups(docs).collect()))
    assert sum(x[2] > 1 for x in want) > 100
    for runs in (2, exact_dedup.RUNS):
        assert sorted(map(tuple, exact_dedup.exact_groups(docs, runs=runs).collect())) == want


def test_memtables_are_flushed_when_full(spark):
    rows = spark.createDataFrame([(i, bytes([i % 7]), i) for i in range(100)], "doc_id long, key binary, entry_id long").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    runs = exact_dedup.flush(rows, most=5).collect()
    assert len(runs) > 7 and sum(x["n"] for x in runs) == 100
    merged = exact_dedup.merge(exact_dedup.flush(rows, most=5)).collect()
    assert sorted((bytes(x["key"])[0], x["keep_id"]) for x in merged) == [(k, max(i for i in range(100) if i % 7 == k)) for k in range(7)]


def test_exact_dedup_of_nothing(empty):
    assert exact_dedup.exact_groups(empty).count() == exact_dedup.exact_groups(empty, runs=3).count() == 0
    assert exact_dedup.drop_exact_copies(empty).columns == empty.columns


def test_filter_keys_are_the_same_in_both_forms(spark):
    digests = [hashlib.sha256(bytes([i])).digest()[: 32 if i % 3 else 1] for i in range(200)]
    got = [x["key"] for x in spark.createDataFrame([(i, x) for i, x in enumerate(digests)], "i int, sha binary").select("i", exact_dedup._key().alias("key")).orderBy("i").collect()]
    assert got == exact_dedup._keys(digests).tolist()


def test_exact_copies_are_dropped(clashing):
    out = exact_dedup.drop_exact_copies(clashing)
    assert out.columns == clashing.columns
    kept = [(d, h) for d, _, _, keep, h in brute_exact([x[:2] for x in odd_rows()]) if keep]
    got = [(x["doc_id"], hashlib.sha256(lowered(x["text"]).encode()).hexdigest()) for x in out.collect()]
    assert sorted(got, key=repr) == sorted(kept, key=repr)


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    rng = random.Random(5)
    texts = ["", " \x0b", "one", "one two", "A b\tC d", "x " * 20000, "é É ß", *(sentence(rng, rng.randrange(1, 60)) for _ in range(50)), "a\x1cb \x85c d"]
    for x in texts:
        assert simhash.fingerprint(x.encode()) == brute_fingerprint(x), x


def test_golay_table_decodes_within_three_bits():
    table = simhash.golay_table()
    codewords = np.zeros(1, dtype=np.uint32)
    for k in range(12):
        codewords = np.concatenate([codewords, codewords ^ np.uint32(simhash.GOLAY << k)])
    words = np.random.default_rng(1).integers(0, 1 << 23, 20000).astype(np.uint32)
    assert (np.bitwise_count(codewords[table[words]] ^ words) <= 3).all()
    assert len(set(codewords.tolist())) == 4096


def test_words_two_bits_apart_share_an_index():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 23, 3000).astype(np.uint32)
    for _ in range(5):
        flips = (1 << rng.integers(0, 23, 3000) | 1 << rng.integers(0, 23, 3000)).astype(np.uint32)
        a, b = simhash.golay_indices(words), simhash.golay_indices(words ^ flips)
        assert all(set(x) & set(y) for x, y in zip(a.tolist(), b.tolist()))
    assert {len(set(x)) for x in simhash.golay_indices(words).tolist()} == {1, 6}


def brute_components(points, linked):
    """The smallest member of each point's component, with linked(a) giving the places of those linked to a."""
    parent = list(range(len(points)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(points)):
        for j in linked(i):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(points))]


@pytest.mark.parametrize("most", [1, 32])
def test_links_connect_what_is_near(spark, monkeypatch, most):
    # With one fingerprint for a joined key nearly all links come from the words between.
    monkeypatch.setattr(simhash, "MAX_PAIRED", most)
    rng = random.Random(4)
    points = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(900):
        points.append(rng.choice(points) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    points = sorted(set(points))
    signed = np.array(points, dtype=np.uint64).view(np.int64)
    links = simhash.links_between(spark.createDataFrame([(int(x),) for x in signed], "fp long"))
    values = np.array(points, dtype=np.uint64)
    got = {(x["u"], x["v"]) for x in links.collect()}
    assert all(((u ^ v) & (2**64 - 1)).bit_count() <= 2 for u, v in got)
    place = {int(x): i for i, x in enumerate(signed)}
    near = brute_components(points, lambda i: np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2))
    edges = defaultdict(list)
    for u, v in got:
        edges[place[u]].append(place[v])
    assert brute_components(points, lambda i: edges[i]) == near


def test_near_duplicates(spark, clashing):
    rows = [x[:2] for x in odd_rows()]
    prints = [brute_fingerprint(x) for _, x in rows]
    values = np.array(prints, dtype=np.uint64)
    roots = brute_components(prints, lambda i: np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2))
    names = {}
    for (doc, _), root in zip(rows, roots):
        names[root] = min((x for x in (names.get(root), doc) if x is not None), default=None)
    want = sorted(((d, f"{p:016x}", names[r]) for (d, _), p, r in zip(rows, prints, roots)), key=repr)
    assert rows_of(simhash.near_duplicates(clashing), "doc_id", "fingerprint", "component_id") == want


def test_near_duplicates_of_nothing(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_copies(empty).columns == empty.columns


def test_one_document_of_each_component_stays(spark):
    rng = random.Random(9)
    base = sentence(rng, 400)
    rows = [(i, base + (" x" if i % 3 == 0 else ""), "en", "s", 1) for i in range(30, 60)] + [(1, sentence(rng, 300), "en", "s", 1)]
    docs = spark.createDataFrame(rows, COLUMNS)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    by = dict(rows_of(simhash.near_duplicates(docs), "doc_id", "component_id"))
    assert {x["doc_id"] for x in kept.collect()} == set(by.values())


def test_rows_of_one_or_no_identifier_go_each_by_its_component(spark):
    rng = random.Random(11)
    a, b, c, d = (sentence(rng, 400) for _ in range(4))
    rows = [(7, a), (None, a + " "), (None, b), (3, c), (5, c + " "), (5, d)]
    kept = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(kept) == sorted([(7, a), (None, b), (3, c), (5, d)], key=repr)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 180)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)] + [(5, 5), (5, 4)]
    got = dict(rows_of(components.connected_components(spark.createDataFrame(links, "u long, v long"))))
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 180)}, **{i: 200 for i in range(200, 207)}}
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_lines(rows, min_docs, least):
    key = lambda line: lowered(line.strip(" \t\n\x0b\x0c\r"))
    split = [(doc, (text or "").split("\n")) for doc, text in rows]
    counts = Counter(k for _, lines in split for k in {key(x) for x in lines})
    out = []
    for doc, lines in split:
        kept = [x for x in lines if not (len(key(x)) >= least and counts[key(x)] >= min_docs)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_broadcast", [line_dedup.MAX_BROADCAST, 0])
@pytest.mark.parametrize(("min_docs", "least"), [(10, 1), (2, 6)])
def test_common_lines_are_dropped(clashing, max_broadcast, min_docs, least):
    got = line_dedup.drop_common_lines(clashing, min_docs, least, max_broadcast)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept") == brute_lines([x[:2] for x in odd_rows()], min_docs, least)


def test_hot_lines_are_dealt_over_copies_of_a_shard(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LINES_AT_A_TIME", 16)
    rng = random.Random(2)
    rows = [(i, "\n".join(["Hot line ", sentence(rng, 3), " hot LINE"])) for i in range(200)]
    got = line_dedup.drop_common_lines(spark.createDataFrame(rows, "doc_id long, text string"), 10, 1, 0)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept") == brute_lines(rows, 10, 1)


def test_lines_of_nothing(empty):
    assert line_dedup.drop_common_lines(empty).count() == 0
    with pytest.raises(ValueError):
        line_dedup.drop_common_lines(empty, 1)


def test_perfect_hash_is_minimal_and_knows_strangers():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        keys = rng.integers(0, 1 << 63, n).astype(np.uint64)
        made = line_dedup.PerfectHash.from_bytes(line_dedup.PerfectHash.build(np.unique(keys)).to_bytes())
        assert sorted(made.find(np.unique(keys)).tolist()) == list(range(len(np.unique(keys))))
    hashes = [xxhash.xxh3_128_digest(bytes([i % 256, i // 256])) for i in range(3000)]
    shard = line_dedup.Shard.build(hashes[:2000], np.arange(2000) + 2)
    assert shard.count(hashes).tolist() == [*range(2, 2002), *[0] * 1000]


def test_filters_hold_their_keys_and_few_others(spark):
    rng = np.random.default_rng(8)
    keys = rng.integers(-(2**63), 2**63 - 1, 3000)
    made = common.key_filter(spark.createDataFrame([(int(x),) for x in keys[:2000]], "key long"))
    assert made.may_hold(keys[:2000]).all() and made.may_hold(keys[2000:]).sum() < 20
    passed = spark.createDataFrame([(int(x),) for x in keys], "key long").filter(common.may_hold(made, spark)(F.col("key"))).count()
    assert passed == made.may_hold(keys).sum()
    nothing = common.key_filter(spark.createDataFrame([], "key long"))
    assert not nothing.may_hold(keys).any()


def test_a_full_filter_lets_more_through_but_loses_none(spark, monkeypatch):
    monkeypatch.setattr(common, "MAX_FILTER_BITS", 1 << 10)
    monkeypatch.setattr(common, "BITS_PER_KEY", 1)
    keys = np.random.default_rng(9).integers(-(2**63), 2**63 - 1, 5000)
    made = common.key_filter(spark.createDataFrame([(int(x),) for x in keys], "key long"))
    assert made.may_hold(keys).all()


def test_written_tables_are_deleted(spark):
    began = common.mark(spark)
    a, b = (common.materialise(spark.range(10)) for _ in range(2))
    assert common.clean_up(spark, began, began + 1) == 1 and b.count() == 10
    assert common.clean_up(spark, began) == 1 and common.clean_up(spark, began) == 0
    with pytest.raises(Exception, match="(?i)not.*exist|path"):
        spark.read.parquet(a.inputFiles()[0]).count()


@pytest.mark.parametrize("places", [1, 4])
def test_large_filters_are_put_together_by_chunks(spark, places):
    table = spark.range(60_000).select(F.xxhash64("id").alias("key")).repartition(3)
    made = common.key_filter(table, most_places=places)
    assert len(made.words) == 2 * common.CHUNK and made.places == places
    keys = np.array([x["key"] for x in table.collect()], dtype=np.int64)
    at = common.KeyFilter.at(keys, 64 * len(made.words), places).ravel()
    want = np.zeros(len(made.words), dtype=np.uint64)
    np.bitwise_or.at(want, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    assert (made.words == want).all() and made.may_hold(keys).all()
