"""Decontamination, the Jaccard join and the pipeline against plain versions."""

import itertools
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import components, decontaminate, jaccard_join, language, secret_scan
from millrace.llm.words import word_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


# --- words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aAbB é\n\t \x1c", max_size=12)), max_size=6))
def test_word_hashes_tell_words_apart(texts):
    hashes, doc = word_hashes(pa.array(texts, pa.string()))
    words = [(n, w) for n, t in enumerate(texts) for w in SPACE.findall((t or "").translate(LOWER))]
    assert doc.tolist() == [n for n, _ in words]
    assert len(set(zip(hashes.tolist(), (w for _, w in words)))) == len({w for _, w in words})


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    from millrace.llm import words

    text = "some words of which xxxxxxxxxxxxxxxxxxxxxxxxx is long"
    whole = word_hashes(pa.array([text], pa.string()))[0]
    monkeypatch.setattr(words, "SEGMENT", 8)
    words.powers.cache_clear()
    assert word_hashes(pa.array(["", None, text], pa.string()))[0].tolist() == whole.tolist()
    words.powers.cache_clear()


# --- components


def test_components_of_paths_stars_and_cycles(spark, tmp_path):
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    found = components.connected(spark.createDataFrame(edges, "a long, b long"), str(tmp_path / "c")).collect()
    want = {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)} | {n: 200 for n in (200, 201, 202)}
    assert {r["node"]: r["label"] for r in found} == want
    none = spark.createDataFrame([], "a long, b long")
    assert components.connected(none, str(tmp_path / "n")).count() == 0


# --- Jaccard join


def plain_components(rows, size=5, share=75):
    sets, root = {}, {}
    for doc, text in rows:
        words = SPACE.findall((text or "").translate(LOWER))
        own = set(zip(*(words[n:] for n in range(size)))) or ({tuple(words)} if words else set())
        sets[doc], root[doc] = own, doc

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= share * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def families(seed, vocabulary=200):
    r = random.Random(seed)
    words = [f"w{n}" for n in range(vocabulary)]
    rows = []
    for length in (1, 2, 4, 5, 6, 8, 12, 30, 60, 150):
        base = r.choices(words, k=length)
        for _ in range(18):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                own[r.randrange(length)] = r.choice(words)
            rows.append((len(rows), " ".join(own)))
    shared = " ".join(r.choices(words, k=70))
    rows += [(len(rows) + n, shared + " " + " ".join(r.choices(words, k=n))) for n in range(0, 40, 2)]
    return [*rows, (9000, None), (9001, ""), (9002, " \n"), (9003, "A b  C"), (9004, "a B c")]


@pytest.mark.parametrize("frequent,crowd", [(2, 3), (6, 8), (32, 64)])
def test_components_equal_brute_force(spark, monkeypatch, frequent, crowd):
    monkeypatch.setattr(jaccard_join, "LEAST_FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rows = families(frequent)
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_shingles", F.lit("x"))
    found = jaccard_join.components(table.repartition(3)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain_components(rows)


def test_components_in_many_rounds_and_without_large_tables(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(jaccard_join, "LEAST_ROUND", 6000)
    monkeypatch.setattr(jaccard_join, "CROWD", 3)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    written, real = [], jaccard_join.saved
    monkeypatch.setattr(jaccard_join, "saved", lambda df, path: written.append((path, df.columns)) or real(df, path))
    rows = families(3)
    found = jaccard_join.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == plain_components(rows)
    names = [path.split("/", 1)[1] for path, _ in written]
    assert sum("/first-links/" in n for n in names) > 1
    assert sum("/second-links/" in n or "/crowd-links/" in n for n in names) > 2
    # counts of all shingles are shuffled, not stored
    assert not any("value" in columns and "n" in columns for _, columns in written)


def test_only_the_wanted_copy_of_a_text_gives_its_set(monkeypatch):
    text = "one two three four five six seven eight"
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([4, 5, None], pa.int64()), "text": [text] * 3})
    own = jaccard_join.class_of(next(jaccard_join.shingle_sets(batch.column(1), 5)))

    def bits(number):
        whole = np.zeros(1 << jaccard_join.FILTER_BITS, np.uint8)
        whole[number % (1 << jaccard_join.FILTER_BITS)] = 1
        return SimpleNamespace(value=np.packbits(whole).tobytes())

    for wanted, ids in ((5, [5]), (jaccard_join.NO_ID, [jaccard_join.NO_ID])):
        found = pa.Table.from_batches(jaccard_join.needed_sets([batch], 5, bits(own), bits(wanted)))
        assert found["rep"].to_pylist() == ids
    found = pa.Table.from_batches(jaccard_join.needed_sets([batch], 5, bits(own + 1), bits(5)))
    assert found.num_rows == 0


def test_counted_values_are_kept_in_few_bytes():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 1 << 18, np.uint32))
    held = jaccard_join.planes(jaccard_join.steps(values))
    assert np.array_equal(np.cumsum(jaccard_join.unplaned(held), dtype=np.uint32), values)
    assert len(pa.compress(held, "lz4", asbytes=True)) < 0.75 * values.nbytes
    ones = np.ones(1 << 18, np.uint32)
    assert len(pa.compress(jaccard_join.planes(ones), "lz4", asbytes=True)) < 0.01 * ones.nbytes


def test_common_counts_equal_sets(monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 50)
    r = random.Random(4)
    sides = [[sorted(r.sample(range(60), r.randrange(1, 30))) for _ in range(n)] for n in (9, 7)]
    wide = [[np.array([v << 20 for v in x], np.uint64) for x in side] for side in sides]
    packed = [[x.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes() for x in side] for side in wide]
    tokens, owners, sizes = zip(*(jaccard_join.held_tokens(p) for p in packed))
    found = jaccard_join.common_counts(tokens, owners, (9, 7))
    want = [[len(set(a) & set(b)) for b in sides[1]] for a in sides[0]]
    assert found.tolist() == want
    assert sizes[0].tolist() == [len(x) for x in sides[0]]


def test_join_of_repeated_and_null_ids(spark):
    a, b = "one two three four five six seven", "red green blue black white grey pink"
    rows = [(5, a), (3, b), (3, a), (3, a), (None, b), (7, None)]
    found = jaccard_join.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["component_id"]) for r in found) == sorted(
        (d is None, d, 7 if t is None else 3) for d, t in rows
    )
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.components(empty).count() == 0


def test_one_of_each_group_stays(spark):
    rows = families(1)
    groups = plain_components(rows)
    table = spark.createDataFrame([(d, t, None, "s", 1) for d, t in [*rows, rows[0]]], DOCS)
    kept = jaccard_join.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in groups.values()})


def test_rows_that_filters_tell_are_not_shuffled(spark, monkeypatch):
    rows = families(1)
    groups = plain_components(rows)
    table = spark.createDataFrame([(d, t, None, "s", n) for n in (1, 2) for d, t in rows[:: 2 - n % 2]], DOCS)
    want = sorted({c for d, c in (groups[d] for d, _ in rows)})
    kept = jaccard_join.one_of_each(table)
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    # No row is joined with the keys that go; an exact join sees those that a filter leaves open.
    assert "LeftAnti" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_one_of_each_without_ids_and_with_any_columns(spark):
    a, b, c = (" ".join(f"{x}{n}" for n in range(30)) for x in "abc")
    rows = [(4, a), (None, a), (None, b), (None, b), (None, b + " more"), (None, None), (None, None), (None, " "), (9, None), (7, c)]
    table = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit(1).alias("_nth"), F.lit(2).alias("key"), F.create_map(F.lit("m"), "doc_id").alias("map")
    )
    kept = jaccard_join.one_of_each(table)
    assert kept.columns == table.columns
    found = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert found.pop((None, b), 0) + found.pop((None, b + " more"), 0) == 1
    assert found == {(4, a): 1, (7, c): 1, (9, None): 1, (None, None): 2, (None, " "): 1}


# --- decontamination


def plain_overlaps(docs, items):
    token = re.compile(r"[^\W_]+")
    found = set()
    for doc, text in docs:
        have = token.findall((text or "").lower())
        for item, passage in items:
            want = token.findall((passage or "").lower())
            size = min(decontaminate.WINDOW, len(want))
            for shift in range(-len(want), len(have)):
                agree = [0 <= n + shift < len(have) and have[n + shift] == w for n, w in enumerate(want)]
                if any(sum(agree[n : n + size]) >= decontaminate.AGREEMENT * size for n in range(len(want) - size + 1)) and want:
                    found.add((doc, item))
    return found


def passages():
    r = random.Random(9)
    words = [f"v{n}" for n in range(400)]
    items = [(n, " ".join(r.choices(words, k=k))) for n, k in enumerate((40, 25, 16, 13, 7, 5, 3))]
    docs = [(100 + n, " ".join(r.choices(words, k=120))) for n in range(20)]
    for n, passage in items:
        own = passage.upper().split()
        docs.append((n, " ".join(r.choices(words, k=30)) + "; " + ", ".join(own) + "! " + " ".join(r.choices(words, k=30))))
        if len(own) >= 16:
            every_fifth = [f"sub{k}" if k % 5 == 2 else w for k, w in enumerate(own)]
            docs.append((10 + n, "x " * 7 + " ".join(every_fifth)))
            docs.append((20 + n, " ".join(own[-14:])))
            docs.append((30 + n, " ".join(own[:6]) + " other " * 9 + " ".join(own[-6:])))
    return [*docs, (900, None), (901, ""), (0, docs[-1][1])], [*items, (50, None), (51, " ... "), (0, items[0][1])]


def test_overlaps_equal_brute_force(spark, monkeypatch):
    docs, items = passages()
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    want = plain_overlaps(docs, items)
    assert {d for d, _ in want} >= {*range(7), 10, 11, 12, 20, 21, 22}
    assert not {d for d, _ in want} & set(range(100, 120))
    for seeds in (decontaminate.BLOCK_SEEDS, 40):
        monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", seeds)
        rows = decontaminate.overlaps(table, bench).collect()
        assert len(rows) == len({(r["doc_id"], r["item_id"]) for r in rows})
        assert {(r["doc_id"], r["item_id"]) for r in rows} == want
    assert decontaminate.overlaps(table, bench.limit(0)).count() == 0
    assert decontaminate.overlaps(table.limit(0), bench).count() == 0
    kept = decontaminate.without_overlaps(table, bench)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_documents_that_begin_with_an_item(spark):
    r = random.Random(5)
    words = [f"v{n}" for n in range(400)]
    items = [(n, " ".join(r.choices(words, k=k))) for n, k in enumerate((40, 20, 13, 9, 7, 6, 4, 1))]
    docs = [(n, passage) for n, passage in items]
    docs += [(10 + n, passage + " " + " ".join(r.choices(words, k=25))) for n, passage in items]
    docs += [(20 + n, " ".join(passage.split()[1:]) + " tail") for n, passage in items]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_overlaps(docs, items)
    assert want >= {(n, n) for n in range(8)} | {(10 + n, n) for n in range(8)} | {(20, 0), (21, 1)}
    found = decontaminate.overlaps(table, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    kept = decontaminate.without_overlaps(table, bench).collect()
    assert not {r["doc_id"] for r in kept} & {*range(8), *range(10, 18), 20, 21}


def test_contaminated_rows_without_ids_go(spark):
    item = " ".join(f"v{n}" for n in range(20))
    docs = [(None, "well " + item), (None, "clean"), (None, None), (3, item), (4, "one two")]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumn("doc", F.lit(1))
    bench = spark.createDataFrame([(None, item), (5, "two"), (5, "two")], "item_id long, text string")
    kept = decontaminate.without_overlaps(table, bench, least_words=4)
    assert kept.columns == table.columns
    assert sorted(map(str, (r["text"] for r in kept.collect()))) == ["None", "clean", "one two"]
    assert [r["text"] for r in decontaminate.left_out(bench, 4).collect()] == ["two", "two"]
    assert decontaminate.without_overlaps(table, bench).count() == 2


def test_very_long_items_send_no_words_with_their_seeds(spark):
    item = [f"v{n}" for n in range(5000)]
    docs = [(1, " ".join(item)), (2, " ".join(item[3000:3013])), (3, " ".join(reversed(item)))]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = decontaminate.overlaps(table, bench).collect()
    assert sorted((r["doc_id"], r["agree"]) for r in found) == [(1, 13), (2, 13)]
    assert {r["doc_id"]: r["start"] for r in found}[2] <= 0


def test_masks_hit_every_pattern_of_the_rule():
    for size in range(1, decontaminate.WINDOW + 1):
        lost = int(size - decontaminate.AGREEMENT * size)
        spots = [
            {at + n for n, counts in enumerate(mask) if counts == "1"}
            for mask in decontaminate.FAMILIES[size]
            for at in range(size - len(mask) + 1)
        ]
        assert all(
            any(not spot & set(pattern) for spot in spots)
            for pattern in itertools.combinations(range(size), lost)
        )


def test_random_substitutions_equal_brute_force(spark):
    r = random.Random(11)
    words = [f"v{n}" for n in range(400)]
    lengths = (*range(1, 17), 20, 30)
    items = [(n, " ".join(r.choices(words, k=k))) for n, k in enumerate(lengths)]
    docs = []
    for _, passage in items:
        own = passage.split()
        for rate in (0.1, 0.2, 0.25, 0.3):
            for _ in range(6):
                changed = [f"sub{len(docs)}" if r.random() < rate else w for w in own]
                around = [r.choices(words, k=r.choice((0, 3, 9))) for _ in "ab"]
                docs.append((len(docs), " ".join([*around[0], *changed, *around[1]])))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.overlaps(table, bench).collect()
    assert {(x["doc_id"], x["item_id"]) for x in found} == plain_overlaps(docs, items)


# --- pipeline


def corpus(spark):
    r = random.Random(1)
    names = {"xx": "kapa lomi tuna sola mire neva", "yy": "schrug brelt grontz klamp zwist pflon"}
    rows = []
    for n in range(60):
        lang = "xx" if n % 2 else "yy"
        rows.append((n, " ".join(r.choices(names[lang].split(), k=40)), lang, "s", 9))
    rows += [(100, rows[3][1], "xx", "s", 9), (101, None, None, None, None), (102, "...", "xx", "s", 3), (3, rows[3][1], "xx", "s", 9)]
    rows.append((103, rows[4][1] + " token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"", "yy", "s", 9))
    rows.append((104, rows[5][1] + " " + rows[7][1], "xx", "s", 9))
    return spark.createDataFrame(rows, DOCS), rows


def test_pipeline_equals_plain_python(spark, tmp_path):
    docs, rows = corpus(spark)
    passage = " ".join(rows[10][1].split()[5:30])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    models = tuple(language.train(docs).items())
    kept = [row for row in rows if not language.judge(row[1], models)[2]]
    groups = plain_components([(r[0], r[1]) for r in kept])
    one = {r[0]: r for r in kept if groups[r[0]][1] == r[0]}
    leaked = {d for d, _ in plain_overlaps([(d, r[1]) for d, r in one.items()], [(1, passage)])}
    assert 10 in leaked
    clean = {}
    for doc, row in one.items():
        if doc not in leaked:
            text, at, parts = row[1], 0, []
            for start, end in sorted((m.start(), m.end()) for rule in secret_scan.RULES for m in re.finditer(rule.regex, text) if len(m[rule.group]) >= rule.least):
                if start >= at:
                    parts += [text[at:start], "[SECRET]"]
                at = max(at, end)
            clean[doc] = "".join(parts) + text[at:]

    before, stages = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        before = stages[name] = stage(spark, before, str(tmp_path)).cache()
    columns = docs.columns
    assert all(stages[n].columns == columns for n in ("language", "deduplicate", "decontaminate", "secrets"))
    assert Counter(r["doc_id"] for r in stages["language"].collect()) == Counter(r[0] for r in kept)
    assert sorted(r["doc_id"] for r in stages["deduplicate"].collect()) == sorted(one)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages["secrets"].collect()} == {d: (t, len(t)) for d, t in clean.items()}
    from millrace.llm.packing import encode
    import public_tokenizers

    packed = {}
    for r in stages["pack"].collect():
        packed.setdefault(r["doc_id"], []).append((r["start"], bytes(r["ids"])))
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert {d: np.frombuffer(b"".join(p for _, p in sorted(parts)), "<u4").tolist() for d, parts in packed.items()} == {
        d: [*encode(t, path), 1] for d, t in clean.items()
    }
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.count() == stages["pack"].count()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# --- links of blocks


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 5), st.integers(-5, 5)), max_size=60))
def test_spanning_edges_join_what_all_edges_join(edges):
    def parts(chosen):
        label = {n: n for e in edges for n in e}
        for _ in label:
            for x, y in chosen:
                label[x] = label[y] = min(label[x], label[y])
        return label

    one, other = (np.array([e[n] for e in edges], np.int64) for n in (0, 1))
    kept = jaccard_join.spanning(one, other)
    assert parts([edges[n] for n in kept]) == parts(edges)
    nodes = {n for e in edges for n in e}
    assert len(kept) == len(nodes) - len(set(parts(edges).values()))
