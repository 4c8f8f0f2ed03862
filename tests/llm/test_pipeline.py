"""The pipeline, stage by stage, and the registered queries."""

from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import COLUMNS, odd_rows, sentence
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from cuesheet.llm import exact_dedup, langid, near_copies, packing, secrets, simhash
from cuesheet.llm.queries import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")


def test_stages_are_in_order():
    assert [x for x, _ in corpus_pipeline.STAGES] == ["language id", "exact dedup", "near dedup", "secret scans", "packing"]


def test_each_stage_takes_effect(spark, clashing, tmp_path):
    path = str(tmp_path / "documents.parquet")
    clashing.write.parquet(path)
    docs = spark.read.parquet(path)
    model = langid.fit(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < 4:
            assert out.columns == clashing.columns
            out.write.parquet(f"{tmp_path}/{k}")
            after = spark.read.parquet(f"{tmp_path}/{k}")
        if k == 0:
            assert 0 < after.count() == langid.keep_identified(docs, model).count() < docs.count()
            assert after.filter("not text rlike '\\\\p{L}'").count() == 0
        elif k == 1:
            assert after.count() == exact_dedup.exact_groups(docs).filter("kept").count() < docs.count()
            assert exact_dedup.exact_groups(after).filter("group_size > 1").count() == 0
        elif k == 2:
            assert simhash.near_duplicates(after).filter("component_id <> doc_id").count() == 0
        elif k == 3:
            assert after.count() == docs.count() and secrets.scan_secrets(after).filter("spans <> ''").count() == 0
        else:
            pieces = out.select("doc_id").distinct().collect()
            assert {x["doc_id"] for x in pieces} == {x["doc_id"] for x in docs.select("doc_id").collect()}
        docs = after


def test_texts_stay_where_no_row_has_a_label(spark, clashing, tmp_path):
    docs = clashing.withColumn("lang", F.lit(None).cast("string"))
    out = corpus_pipeline.identified(spark, docs, str(tmp_path))
    want = [x["text"] for x in docs.collect() if any(map(str.isalpha, x["text"] or ""))]
    assert want and sorted(x["text"] for x in out.collect()) == sorted(want)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_hashes_are_packed():
    rng = np.random.default_rng(1)
    for values in ([], [0], [5, 5, 6], rng.integers(0, 1 << 48, 5000), rng.integers(0, 300, 400)):
        own = np.sort(np.array(values, dtype=np.uint64))
        assert near_copies.unpack(near_copies.pack(own)).tolist() == own.tolist()


def test_sketches_rule_out_no_alike_sets():
    rng = np.random.default_rng(2)
    ruled_out = 0
    for _ in range(300):
        n = int(rng.integers(1, 900))
        pool = np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, 2 * n + 2))
        a, b = (np.sort(rng.choice(pool[: int(len(pool) * rng.uniform(0.5, 1))], min(n, len(pool) // 2), replace=False)) for _ in range(2))
        if rng.random() < 0.5:
            b = np.union1d(a[rng.random(len(a)) < rng.uniform(0.7, 1)], b[: len(a) // 9])
        shared = len(np.intersect1d(a, b))
        alike = shared >= 0.8 * (len(a) + len(b) - shared) - 1e-9
        may = near_copies.may_be_alike(near_copies.sketch(a), near_copies.sketch(b), 0.8)
        assert may or not alike
        ruled_out += not may
    assert ruled_out > 50
    crowded = np.arange(300, dtype=np.int64)
    assert near_copies.sketch(crowded) == b"" and near_copies.may_be_alike(b"", near_copies.sketch(pool), 0.8)


def test_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "SHARD", 100)
    rng = random.Random(1)
    pool = [rng.getrandbits(64) - 2**63 for _ in range(800)]
    rows = [([rng.choice(pool) for _ in range(rng.randrange(6))],) for _ in range(300)]
    counts = Counter(x for own, in rows for x in set(own))
    twice = Counter(x for own, in rows for x in own)
    got = {x["key"] for x in near_copies.repeated_keys(spark.createDataFrame(rows, "keys array<long>").repartition(3), 800).collect()}
    assert {(x % 2**64) >> 16 for x, n in counts.items() if n > 1} <= got == {(x % 2**64) >> 16 for x, n in twice.items() if n > 1}


def test_words_have_one_hash_wherever_they_are(monkeypatch):
    monkeypatch.setattr(near_copies, "PIECE", 50)
    rng, seen = random.Random(8), {}
    for _ in range(500):
        own = [bytes(rng.choice(b"abAB\x00\xc3") for _ in range(rng.choice([1, 2, 3, 31, 32, 33, 70]))) for _ in range(rng.randrange(12))]
        text = b"".join(rng.choice([b" ", b"\n", b"  ", b"\t\x0b", b"\r\x0c"]) + x for x in own) + rng.choice([b"", b" "])
        hashes = near_copies.word_hashes(text).tolist()
        assert len(hashes) == len(own)
        for word, got in zip(text.lower().split(), hashes):
            assert seen.setdefault(word, got) == got
    assert len(set(seen.values())) == len(seen) > 1000
    sets = [near_copies.shingle_hashes(x, 2) for x in (b"a b c a b", b" A\nb  c a b ", b"a b c a", b"b a c", b"", b"  ")]
    assert [len(x) for x in sets] == [3, 3, 3, 2, 1, 1] and all(sets[0].tolist() == x.tolist() for x in sets[1:3]) and sets[4] == sets[5]
    assert not set(sets[0].tolist()) & set(sets[3].tolist())


def test_documents_with_too_much_of_their_own_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "MANY_DOCS", 0)
    read, prefixes = [], near_copies._prefixes
    monkeypatch.setattr(near_copies, "_prefixes", lambda docs, *more: read.append(docs.count()) or prefixes(docs, *more))
    rng = random.Random(9)
    passage = sentence(rng, 40)
    rows = [(k, f"{sentence(rng, 60)} {passage} {sentence(rng, 60)}") for k in range(40)]
    sets = lambda: [{tuple(x.lower().split()[i : i + 5]) for i in range(max(1, len(x.split()) - 4))} for _, x in rows]
    for k in range(10):
        own = rows[k][1].split()
        for at in rng.sample(range(160), k):
            own[at] = f"new{rng.randrange(10**6)}"
        rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + k, x) for k, x in enumerate(["", "  ", "one two", "one  Two"])]
    linked = [[j for j, b in enumerate(sets()) if 5 * len(a & b) >= 4 * len(a | b)] for a in sets()]
    root = list(range(len(rows)))
    for _ in rows:
        root = [min(root[j] for j in own) for own in linked]
    want = sorted(set(root))
    rows.append((None, sentence(rng, 30)))
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in rows], COLUMNS).repartition(3)
    got = sorted(corpus_pipeline.near_copies(spark, docs, "").collect(), key=lambda x: (x["doc_id"] is None, x["doc_id"]))
    assert [x["doc_id"] for x in got] == [*want, None] and 40 < len(want) < 50
    assert read[0] < 35


def test_near_copies_by_fingerprint_are_found_without_prefixes(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "_rows", lambda prefixes, repeated: prefixes.limit(0).select(F.col("node").alias("key"), "node", "size", F.lit(0).alias("at")))
    rng = random.Random(5)
    rows = []
    for _ in range(8):
        base = sentence(rng, 900).split()
        for k in range(4):
            own = list(base)
            if k:
                own[rng.randrange(900)] = f"new{k}"
            rows.append((len(rows), " ".join(own)))
    # Few words often: one fingerprint, other shingles.
    rows += [(len(rows), "a b c " * 40 + "d"), (len(rows) + 1, "a b c " * 40 + "d e f g h i")]
    fps = [simhash.fingerprint(x.encode()) for _, x in rows]
    sets = [{tuple(x.split()[i : i + 5]) for i in range(len(x.split()) - 4)} for _, x in rows]
    near = [[j for j in range(len(rows)) if (fps[i] ^ fps[j]).bit_count() <= 2] for i in range(len(rows))]
    assert any(5 * len(sets[i] & sets[j]) < 4 * len(sets[i] | sets[j]) for i in range(len(rows)) for j in near[i])
    seen, want = set(), []
    for i in range(len(rows)):
        if i not in seen:
            want.append(i)
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += [j for j in near[x] if 5 * len(sets[x] & sets[j]) >= 4 * len(sets[x] | sets[j])]
    assert len(want) < len(rows) - 8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(x["doc_id"] for x in corpus_pipeline.near_copies(spark, docs, "").collect()) == want


def test_fingerprint_pairs_connect_what_two_bits_do(spark):
    rng = random.Random(6)
    fps = [rng.getrandbits(64) for _ in range(40)]
    fps += [x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in fps[:20]] + fps[10:25]
    nodes = [(k * 1001 - 30_000, int(np.uint64(x).astype(np.int64))) for k, x in enumerate(fps)]
    pairs = {tuple(x) for x in simhash.fingerprint_pairs(spark.createDataFrame(nodes, "node long, fp long")).collect()}
    by = dict(zip((x for x, _ in nodes), fps))
    assert all(u > v and (by[u] ^ by[v]).bit_count() <= 2 for u, v in pairs)

    def groups(links):
        root = {x: x for x in by}
        for _ in by:
            for u, v in links:
                root[u] = root[v] = min(root[u], root[v])
        return root

    assert groups(pairs) == groups([(a, b) for a in by for b in by if (by[a] ^ by[b]).bit_count() <= 2])


def test_ids_are_handed_on_in_small_batches(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(packing, "BATCH_IDS", 5000)
    monkeypatch.setattr(packing, "_rows", lambda rows, with_ids, own=packing._rows: sizes.append(sum(len(x[7]) for x in rows)) or own(rows, with_ids))
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 0})())
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(7)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(60), pa.int64()), "text": [sentence(rng, 800) for _ in range(60)]})

    class Docs:
        sparkSession = spark

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return pa.Table.from_batches(list(run(iter([batch]))))

    out = packing.packed_ids(Docs(), path)
    assert sum(sizes) == sum(out["length"].to_pylist()) > 40_000 and max(sizes) <= 5000 + packing.CAPACITY
    assert out["ids"].combine_chunks().value_lengths().to_pylist() == out["length"].to_pylist()


@pytest.mark.parametrize("apart", [32, 2])
def test_near_copies_are_dropped_as_by_brute_force(spark, monkeypatch, apart):
    monkeypatch.setattr(near_copies, "APART", apart)
    monkeypatch.setattr(near_copies, "MANY_PAIRS", 0)
    rng = random.Random(3)
    rows, shared = [], sentence(rng, 20)
    for k in range(12):
        base = sentence(rng, 150).split() + (shared.split() if k % 2 else [])
        rows.append((len(rows), " ".join(base)))
        for edits in (1, 2, 3, 4, 5, 9):
            own = list(base)
            for at in rng.sample(range(150), edits):
                own[at] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    sets = [{tuple(x.split()[i : i + 5]) for i in range(len(x.split()) - 4)} for _, x in rows]
    linked = [[j for j, b in enumerate(sets) if i != j and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)]
    seen, want = set(), []
    for i in range(len(rows)):
        if i not in seen:
            want.append(i)
            stack = [i]
            while stack:
                x = stack.pop()
                if x not in seen:
                    seen.add(x)
                    stack += linked[x]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in rows], COLUMNS)
    got = {x["doc_id"] for x in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert 12 < len(want) < 60 and sorted(got) == want


def test_near_copies_with_a_passage_in_common_are_compared_once(spark, monkeypatch):
    compared, verified = [], near_copies._verified

    def counted(pairs, *more):
        compared.append((pairs.count(), pairs.distinct().count()))
        return verified(pairs, *more)

    monkeypatch.setattr(near_copies, "_verified", counted)
    rng = random.Random(5)
    rows = []
    for _ in range(15):
        passage = sentence(rng, 40)
        rows += [(len(rows) + k, f"{sentence(rng, 20)} {passage} {sentence(rng, 20)}") for k in range(4)]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in rows], COLUMNS)
    assert corpus_pipeline.near_copies(spark, docs, "").count() == len(rows)
    pairs, distinct = compared[-1]
    assert pairs == distinct > 20


def test_a_large_group_is_compared_with_its_least_edited_nodes(spark):
    # Nodes 0 to 9 have no shingle of their own before the group's, others have more; each is its own component.
    rows = [(key, node, 100, key + (node >= 10) * (1 + node % 7), node) for node in range(300) for key in range(3)]
    placed = spark.createDataFrame(rows, "key long, node long, size int, at int, root long")
    crowded = spark.createDataFrame([(key, 300) for key in range(3)], "key long, all long")
    fits = lambda a, b: f"least({a}.size, {b}.size) > 0"
    used = None
    for _ in range(2):
        pairs = near_copies.hub_pairs(near_copies._crowded_rows(placed, crowded), crowded, used, fits).collect()
        hubs = {x["v"] for x in pairs}
        assert len(hubs) <= near_copies.HUBS and len(pairs) <= near_copies.HUBS * 300 and {x["u"] for x in pairs} == set(range(300))
        if used is None:
            assert any(x < 10 for x in hubs) and all(x["u"] != x["v"] for x in pairs)
        else:
            assert not hubs & first
        first, used = hubs, spark.createDataFrame([(x,) for x in hubs], "node long")


def test_secrets_are_masked_with_one_python_worker_a_task(spark, monkeypatch):
    rows = [(k, f"text {k}" + " token=abcdefgh12345678" * (k % 2), "en", "s", 0) for k in range(20)]
    docs = spark.createDataFrame(rows, COLUMNS)
    monkeypatch.setattr(type(spark), "createDataFrame", None)  # an empty table made of a Python list starts workers of another kind
    out = secrets.redact_secrets(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    masks = [k for k, x in enumerate(plan) if "ArrowEvalPython" in x and "masked" in x]
    assert masks
    for k in masks:
        below = [x for x in plan[k + 1 :]]
        assert next(x for x in below if "RebalancePartitions" in x or "ArrowEvalPython" in x and "probe" in x).find("RebalancePartitions") >= 0
    assert {x["text"] for x in out.collect()} == {f"text {k}" + " <SECRET>" * (k % 2) for k in range(20)}


ENGLISH = "the of and to in that is was for with on are this be which have from not they".split()
GERMAN = "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als".split()


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def spoken(rng, words, n):
    return " ".join(rng.choice(words) + rng.choice(["", "", ".", ","]) for _ in range(n))


def test_the_pipeline_against_brute_force(spark, tmp_path):
    """Each stage by hand over a table with all that they look for: what is left, and the ids it is packed as."""
    rng = random.Random(21)
    rows = [(i, spoken(rng, words, 150), lang) for i, (words, lang) in enumerate([(ENGLISH, "en"), (GERMAN, "de")] * 25)]
    noise = ["".join(rng.choice("qxzjkvwp") for _ in range(9)) for _ in range(60)]
    rows += [(100, " ".join(noise), None), (101, None, "en"), (102, "", None), (103, "123 !?", "en"), (104, "言語 が 違う 文章", None)]
    rows += [(200 + i, rows[i][1].upper() if i % 2 else rows[i][1], rows[i][2]) for i in range(8)]
    for i in range(300, 310):  # two of 150 words changed touch ten of 146 shingles at most
        own = rows[i - 290][1].split()
        for at in rng.sample(range(150), 2):
            own[at] = "other"
        rows.append((i, " ".join(own), "en"))
    secret = 'and token = "3f76bb46f51625a07193ae74d1cc485f" is set'
    rows += [(400 + i, spoken(rng, ENGLISH, 80) + f"\n{secret}\n" + spoken(rng, ENGLISH, 40), "en") for i in range(5)]
    rows += [(None, spoken(rng, GERMAN, 90), "de")]
    spark.createDataFrame([(d, t, lang, "s", len(t or ""), "x") for d, t, lang in rows], COLUMNS + ", spans string").write.parquet(str(tmp_path / "documents.parquet"))

    left = [(d, t) for d, t, _ in rows if d is None or d < 100 or d >= 200]
    by_text: dict[str, list] = {}
    for d, t in left:
        by_text.setdefault(lowered(t), []).append((d if d is not None else -1, t))
    left = [max(x, key=lambda y: y[0]) for x in by_text.values()]
    sets = [{tuple(lowered(t).split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t in left]
    roots = list(range(len(left)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                roots = [roots[j] if x == roots[i] else x for x in roots]
    kept = {}
    for (d, t), root in zip(left, roots):
        if root not in kept or d < kept[root][0]:
            kept[root] = (d, t)
    want = {}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for d, t in kept.values():
        own = t.replace('token = "3f76bb46f51625a07193ae74d1cc485f', "<SECRET>")
        want[None if d == -1 else d] = [*tokenizer.encode(own, add_special_tokens=False).ids, 1]
    got: dict = {}
    for x in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda x: x["start"]):
        got.setdefault(x["doc_id"], []).extend(x["ids"])
    assert 50 < len(want) < len(rows) - 15
    assert got == want


def test_an_empty_table_passes_through(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    want = connection.execute(ORACLE_SQL[name]).to_arrow_table()
    got = QUERIES[name](spark, str(DATA)).toArrow()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    assert sorted(map(repr, got.select(columns).to_pylist())) == sorted(map(repr, want.select(columns).to_pylist()))


@needs_tables
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_other_queries_run_over_whole_tables(spark, name):
    table, key = {"op3": ("pages", "page_id"), "op13": ("conversations", "conv_id")}.get(name.split("_")[0], ("documents", "doc_id"))
    want = {x[0] for x in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect()}
    assert {x[0] for x in QUERIES[name](spark, str(DATA)).select(key).collect()} == want


def test_rows_without_text_are_covered():
    assert any(x[1] is None for x in odd_rows())
