"""Fingerprints, near duplicates, decontamination and licences against brute force."""

import hashlib
import re
import textwrap
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import llm_fixtures as fx
from compare import duckdb_result, spark_result
from landfall.llm import decontaminate, licenses, near_duplicates, queries, winnowing

SMALL = "/root/testdata/sf0.001"


def plain_simhash(text, size=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    size = min(size, len(words))
    hashes = [
        xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), seed=42)
        for i in range(len(words) - size + 1)
    ] if words else []
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def plain_components(prints, distance):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_simhash(r["text"]) for r in rows]
    roots = plain_components(prints, 4)
    expected = [
        (r["doc_id"], f"{p:016x}", rows[k]["doc_id"]) for r, p, k in zip(rows, prints, roots)
    ]
    assert sorted(map(tuple, queries.op7_simhash(spark, SMALL).collect())) == expected


KINDS = [
    near_duplicates.EXACT,
    near_duplicates.Fingerprints(shingle=5, longs=4, parts=16, distance=31, radius=1),
]


@pytest.mark.parametrize("most", [10**6, 40])
@pytest.mark.parametrize("kind", KINDS)
def test_links_lose_none_across_many_shards(spark, monkeypatch, kind, most):
    monkeypatch.setattr(near_duplicates, "SHARD_ROWS", 64)
    monkeypatch.setattr(near_duplicates, "SHARD_MOST", most)
    rng = np.random.default_rng(3)
    bits = 64 * kind.longs
    # pairs within the distance that the parts guarantee
    sure = kind.parts * (kind.radius + 1) - 1
    most = min(kind.distance, sure)
    prints = []
    for _ in range(250):
        base = int.from_bytes(rng.bytes(bits // 8), "little")
        prints.append(base)
        for _ in range(int(rng.integers(0, 4))):
            flips = rng.choice(bits, int(rng.integers(1, most + 1)), replace=False)
            prints.append(base ^ sum(1 << int(b) for b in flips))
    base = prints[0]
    prints += [base ^ (1 << b) ^ (1 << (b + 7) % bits) for b in range(64)]  # a dense ball
    prints = list(dict.fromkeys(prints))
    roots = plain_components(prints, kind.distance)
    rows = []
    for i, p in enumerate(prints):
        longs = np.frombuffer(p.to_bytes(bits // 8, "little"), "<i8").tolist()
        rows.append((i, *longs))
    schema = "node long, " + ", ".join(f"{c} long" for c in kind.columns)
    nodes = spark.createDataFrame(rows, schema)
    edges = near_duplicates.links(nodes, kind)
    assert edges.count() < 40 * len(prints)
    found = dict(map(tuple, near_duplicates.components(edges).collect()))
    assert [found.get(i, i) for i in range(len(prints))] == roots


def test_blocks_of_a_full_shard_are_small_and_every_pair_meets_once():
    rng = np.random.default_rng(2)
    n_rows, cuts = 3000, 7
    node = rng.permutation(n_rows).astype("i8")
    home = rng.random(n_rows) < 0.6
    routed = near_duplicates.pa.RecordBatch.from_pydict(
        {"part": np.full(n_rows, 1, "i4"), "shard": np.where(node < 2500, 5, 6), "home": home,
         "node": node, "f0": node}
    )
    met, sizes = defaultdict(int), defaultdict(int)
    groups = defaultdict(lambda: ([], []))
    for batch in near_duplicates.in_blocks(routed, {(1, 5): cuts, (0, 6): 3}):
        for row in batch.to_pylist():
            groups[row["shard"], row["block"]][0 if row["home"] else 1].append(row["node"])
    for (shard, block), (homes, asking) in groups.items():
        sizes[shard] = max(sizes[shard], len(homes) + len(asking))
        if shard == 5:
            assert not set(homes) & set(asking)
            met[block // cuts] += len(asking)
    assert sizes[6] == 500 and sizes[5] < 2 * 2 * 2500 / cuts
    homes = {n for (s, _), g in groups.items() if s == 5 for n in g[0]}
    assert homes == set(node[home & (node < 2500)].tolist())
    # each block of home rows is asked by every row of the shard but itself
    own = {b: {n for (s, k), g in groups.items() if s == 5 and k // cuts == b for n in g[0]}
           for b in range(cuts)}
    assert all(met[b] == 2500 - len(own[b]) for b in range(cuts))


@pytest.mark.parametrize("kind", KINDS)
def test_shard_tree_finds_what_comparing_all_finds(monkeypatch, kind):
    monkeypatch.setattr(near_duplicates, "BLOCK", 8)
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**63, (300, kind.longs)).astype("u8")
    near = base[rng.integers(0, 300, 300)].copy()
    for row in near:
        for bit in rng.choice(64 * kind.longs, 3, replace=False):
            row[bit // 64] ^= np.uint64(1 << int(bit % 64))
    prints = np.unique(np.concatenate([base, near]), axis=0)
    home = rng.random(len(prints)) < 0.7
    for mask in kind.masks()[:3]:
        differ = prints[:, None] ^ prints[None]
        linked = (np.bitwise_count(differ & mask).sum(axis=-1) <= kind.radius) & home[None]
        linked &= np.bitwise_count(differ).sum(axis=-1) <= kind.distance
        forest = near_duplicates.Forest(len(prints))
        forest.join(*np.nonzero(linked))
        found = near_duplicates.link_shard(prints, home, mask, kind)
        assert found.tolist() == forest.root.tolist()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, j) for j in range(101, 140)] + [(7, 7)]
    found = dict(
        map(tuple, near_duplicates.components(spark.createDataFrame(edges, "a long, b long")).collect())
    )
    assert found == {**{i: 0 for i in range(1, 41)}, **{j: 100 for j in range(101, 140)}}


def test_groups_of_awkward_rows(spark):
    got = near_duplicates.groups(fx.documents(spark)).select("doc_id", "component_id").collect()
    assert len(got) == len(fx.ROWS)
    by_id = defaultdict(set)
    for doc_id, component in got:
        by_id[doc_id].add(component)
    assert by_id[0] == by_id[1] == by_id[10] == {0}
    assert by_id[3] == by_id[4] == {2}  # no words, as the null text of id 2
    assert by_id[2] == {2}  # both texts of one id are in one group
    assert by_id[6] == {6}
    assert near_duplicates.groups(fx.documents(spark, [])).count() == 0


def test_one_of_each_keeps_columns_and_one_row(spark):
    docs = fx.documents(spark)
    kept = near_duplicates.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    # both texts of id 2 stay: the null one stands for all without words
    assert ids == [0, 2, 2, 5, 6, 7, 8, 9, 11, None]
    assert near_duplicates.one_of_each(fx.documents(spark, [])).count() == 0


def test_one_of_each_prefers_rows_with_an_id(spark):
    text = fx.ROWS[0][1]
    rows = [(None, text, "en", "a"), (9, text, "en", "b"), (None, "alone " * 9, "en", "c"),
            (None, "alone " * 9, "en", "d"), (9, "quite another text under one id", "en", "e")]
    kept = near_duplicates.one_of_each(fx.documents(spark, rows).repartition(3))
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert fx.multiset(found) == fx.multiset([rows[1][:2], rows[2][:2], rows[4][:2]])


def plain_contamination(docs, items, window=10):
    def split(text):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    windows = defaultdict(set)
    for item_id, text in items:
        words = split(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if size and item_id is not None else ():
            windows[tuple(words[i : i + size])].add(str(item_id))
    out = []
    for doc_id, text in docs:
        words, hit, found = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                names = windows.get(tuple(words[i : i + size]))
                if names:
                    hit.update(range(i, i + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return fx.multiset(out)


@pytest.mark.parametrize("block_words", [10**6, 3])
def test_contamination_of_awkward_rows(spark, block_words):
    items = [
        (1, "quick brown fox jumps over the lazy dog near the river"),
        (2, "quick brown fox jumps over the lazy dog near the river"),
        (10, "SMILE"),
        (3, "larga y repetida palabra larga y repetida palabra larga y repetida"),
        (4, None),
        (5, "... !!!"),
        (None, "ein"),
        (6, "two blanks"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("uid", F.lit(1))
    got = decontaminate.contamination(fx.documents(spark), benchmark, block_words=block_words)
    expected = plain_contamination([(r[0], r[1]) for r in fx.ROWS], items)
    assert fx.multiset(got.collect()) == expected
    assert {r[5] for r in expected} == {True, False}


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(fx.documents(spark), none).where("contaminated").count() == 0
    assert decontaminate.contamination(fx.documents(spark, []), none).count() == 0
    kept = decontaminate.without_contaminated(fx.documents(spark), none)
    assert kept.count() == len(fx.ROWS)


def test_contamination_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    got = queries.op8_decontamination(spark, SMALL).collect()
    assert fx.multiset(got) == plain_contamination(docs, items)


def test_rows_are_judged_apart_whatever_their_ids(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, "clean", "en", "s"), (None, f"x {item} y", "en", "s"), (3, "clean", "en", "s"),
            (4, item, "en", "s"), (4, "clean too", "en", "s")]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = fx.documents(spark, rows)
    kept = decontaminate.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert fx.multiset(found) == fx.multiset([(None, "clean"), (3, "clean"), (4, "clean too")])


def test_proximity(spark):
    got = decontaminate.proximity_matches(fx.documents(spark), "lazy fox", slop=4).collect()
    assert {tuple(r) for r in got} == {(i, 3, 5) for i in (0, 1, 10)}
    assert decontaminate.proximity_matches(fx.documents(spark), "lazy fox", slop=2).count() == 0
    assert decontaminate.proximity_matches(fx.documents(spark), "...", slop=2).count() == 0


def plain_winnow(hashes, window):
    window = min(window, len(hashes))
    chosen = set()
    for i in range(len(hashes) - window + 1):
        part = hashes[i : i + window]
        chosen.add(max(i + j for j in range(window) if part[j] == min(part)))
    return sorted(chosen)


@pytest.mark.parametrize("text", [r[1] or "" for r in fx.ROWS if r[1] != fx.LONG] + ["ab" * 200])
def test_winnowing_selects_rightmost_minima(text):
    winnower = winnowing.Winnower(k=5, window=8)
    hashes = winnower.grams(text).tolist()
    grams = [text[i : i + 5] for i in range(max(1, len(text) - 4))] if text else []
    assert len(hashes) == len(grams)
    assert all(
        (hashes[i] == hashes[j]) == (grams[i] == grams[j])
        for i in range(len(grams)) for j in range(i)
    )
    found = winnower.fingerprint(text)
    assert found.positions.tolist() == (plain_winnow(hashes, 8) if hashes else [])
    assert found.hashes.tolist() == [hashes[i] for i in found.positions.tolist()]


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    passage = "".join(map(chr, rng.integers(97, 123, 16 + 32 - 1)))
    texts = ["".join(map(chr, rng.integers(97, 123, 300))) for _ in range(2)]
    winnower = winnowing.Winnower()
    a, b = (winnower.fingerprint(t[:77] + passage + t[77:]) for t in texts)
    assert set(a.hashes.tolist()) & set(b.hashes.tolist())


@pytest.mark.parametrize("cell_rows", [4096, 2])
def test_edits_of_awkward_rows(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(winnowing, "CELL_ROWS", cell_rows)
    got = winnowing.compare_edits(fx.documents(spark)).collect()
    rows = sorted(
        ((r[0], r[1] or "") for r in fx.ROWS),
        key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()),
    )
    winnower = winnowing.Winnower()
    expected = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = map(winnower.fingerprint, (text, edited, after))
        expected.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.digest(),
             b.digest(), a.likeness(b), a.likeness(c))
        )
    assert fx.multiset(got) == fx.multiset(expected)


def test_edits_of_one_and_no_document(spark):
    row = winnowing.compare_edits(fx.documents(spark, [(5, "abc" * 30, "en", "s")])).collect()
    assert [r["near_next"] for r in row] == [1.0]
    assert winnowing.compare_edits(fx.documents(spark, [])).count() == 0
    assert winnowing.fingerprints(fx.documents(spark)).count() == len(fx.ROWS)


def licence(name):
    return (licenses.TEXTS / f"{name}.txt").read_text(encoding="utf-8")


def test_licence_texts_in_other_clothes(spark):
    mit = licence("MIT")
    dressed = mit.upper().replace("SUBLICENSE", "SUBLICENCE").replace("<YEAR>", "2021 Someone")
    rows = [
        (0, dressed, "en", "s"),
        (1, mit.replace(",", " ;").replace("\n", "\n\n"), "en", "s"),
        (2, mit + " and more", "en", "s"),
        (3, "text\n  LICENSED under the apache license version 2.0!\nReleased under the MIT License\n", "en", "s"),
        *[(None if r[0] is None else r[0] + 10, *r[1:]) for r in fx.ROWS],
    ]
    got = licenses.scan(fx.documents(spark, rows), licenses.known_digests(spark)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["license_id"] == by_id[1]["license_id"] == "MIT"
    assert by_id[2]["license_id"] is None
    assert by_id[3]["line_license_ids"] == "Apache-2.0-notice,MIT-notice"
    assert by_id[3]["n_license_lines"] == 2
    assert by_id[19]["line_license_ids"] == "CC-BY-NC-4.0-notice"
    nothing = spark.createDataFrame([], "k string, t string")
    known = licenses.digests_of(nothing, "k", "t")
    assert licenses.scan(fx.documents(spark), known).where("license_id is not null").count() == 0
    assert licenses.scan(fx.documents(spark, []), licenses.known_digests(spark)).count() == 0


def wrapped(text, width):
    return "\n\n".join(textwrap.fill(" ".join(p.split()), width) for p in text.split("\n\n"))


def test_every_known_licence_is_found_however_it_is_wrapped(spark):
    names = sorted(path.stem for path in licenses.TEXTS.glob("*.txt"))
    assert {"MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1",
            "MPL-2.0", "CC0-1.0", "Unlicense", "Zlib", "ISC", "BSL-1.0"} <= set(names)
    rows, expected = [], []

    def add(name, text):
        rows.append((len(rows), text, "en", "s"))
        expected.append(name)

    for name in names:
        text = licence(name)
        title, _, rest = text.strip().partition("\n\n")
        add(name, text)
        add(name, rest)
        add(name, wrapped(rest, 61) if name in licenses.TITLES else text.replace("\n", "\r\n"))
        if licenses.END_OF_TERMS in text:
            add(name, text.partition(licenses.END_OF_TERMS)[0] + licenses.END_OF_TERMS)
    mit = licence("MIT")
    body = mit.partition("\n\n")[2]
    add("MIT", "The MIT License (MIT)\n\n" + body)
    held = "Copyright 2020-2024 A. Holder\nAll rights reserved.\n"
    add("MIT", mit.replace("Copyright (c) <year> <copyright holders>\n", held))
    add("MIT", body.replace("copyright notice", "\ncopyright notice").replace("COPYRIGHT HOLDERS", "\nCOPYRIGHT HOLDERS"))
    add(None, body.replace("copyright notice and", ""))
    add(None, mit.replace("free of charge, ", ""))
    got = licenses.scan(fx.documents(spark, rows), licenses.known_digests(spark)).collect()
    found = {r["doc_id"]: r["license_id"] for r in got}
    assert [found[i] for i in range(len(rows))] == expected


def test_licence_query_equals_sql_on_a_table_of_licences(spark, folder):
    names = sorted(path.stem for path in licenses.TEXTS.glob("*.txt"))
    rows = [(i, wrapped(licence(n), 40 + i) if i % 2 else licence(n), "en", "s") for i, n in enumerate(names)]
    rows += [(100, held + licence("ISC"), "en", "s") for held in ("", "Copyright 2001 X\n", "copyright law\n")]
    spark.createDataFrame([*rows, *fx.ROWS], fx.SCHEMA).coalesce(1).write.parquet(folder + "/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/d/*.parquet'")
    expected_schema, expected = duckdb_result(con, queries.ORACLE["op9_license_scan"])
    docs = spark.read.parquet(folder + "/d")
    schema, got = spark_result(licenses.scan(docs, licenses.known_digests(spark)))
    assert schema == expected_schema and got == expected
    assert sum(row[schema.index(("license_id", "VARCHAR"))] is not None for row in got) >= len(names) // 2


def test_native_operators_plan_no_python(spark):
    for name in ("op9_license_scan", "op10_sharding"):
        plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_sharding_query_shuffles_whole_documents(spark, monkeypatch):
    shuffle, seen = queries.sharding.shuffle_to_shards, []

    def marked(df, *args):
        seen.append(df.columns)
        return shuffle(df, *args).withColumn("text", F.lit("seen"))

    monkeypatch.setattr(queries.sharding, "shuffle_to_shards", marked)
    got = queries.op10_sharding(spark, SMALL).select("size", "text_crc32").distinct().collect()
    assert seen == [["doc_id", "text"]]
    assert [tuple(r) for r in got] == [(5, fx.zlib.crc32(b"seen"))]
