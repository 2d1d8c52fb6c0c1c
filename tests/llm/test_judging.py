"""Language, quality, decontamination, urls, neighbours and SentencePiece."""

import os
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.compare import connect, differences
from tests.llm.conftest import sentence
from tillstream.llm import decontaminate, language, neighbours, oracles, pieces, quality, queries, url_filter

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


@pytest.fixture(scope="module")
def model(spark):
    docs = queries.table(spark, SF, "documents")
    return language.fit(docs.where(~language.held_out()))


def test_language_held_out(spark, model):
    docs = queries.table(spark, SF, "documents")
    found = language.predict(docs, model).where(language.held_out()).toPandas()
    assert (found["lang"] == found["lang_pred"]).mean() > 0.98
    assert found["rejected"].mean() < 0.01
    assert found["score"].between(0, 1).all()


def test_held_out(spark):
    found = spark.createDataFrame([(k,) for k in range(30)] + [(None,)], "doc_id long").select("doc_id", language.held_out())
    for i, out in found.collect():
        assert out == (i is None or zlib.crc32(str(i).encode()) % 3 == 1)


def test_language_odd(table, odd_rows, model):
    found = language.predict(table([*odd_rows, (50, "123 $$"), (51, "Быстрая лиса прыгает через собаку")]), model).collect()
    by_id = {(r["doc_id"], r["text"]): r for r in found}
    for at in ((1, None), (2, ""), (3, " \n "), (50, "123 $$")):
        assert (by_id[at]["lang_pred"], by_id[at]["score"], by_id[at]["rejected"]) == ("und", 0, True)
    assert by_id[51, "Быстрая лиса прыгает через собаку"]["rejected"]
    nothing = language.fit(table([]))
    assert {r["lang_pred"] for r in language.predict(table(odd_rows), nothing).collect()} == {"und"}


def test_long_text_counts_as_whole():
    text = "Ab cd é " * (language.CHUNK // 4)
    from pyarrow import array

    (_, whole), = language._counts(array([text]))
    small = sum(np.bincount(p, minlength=language.DIMS) for _, p in language._places([text.lower()]))
    assert np.array_equal(whole[0], small.astype(np.float32))


def test_quality_held_out(spark):
    docs, labels = queries.table(spark, "/root/testdata/sf0.1", "documents"), queries.table(spark, "/root/testdata/sf0.1", "labels")
    test = F.col("doc_id") % 5 == 0
    model = quality.fit(docs, labels.where(~test))
    found = quality.score(docs.join(labels.where(test), "doc_id"), model).toPandas()
    assert ((found["quality_score"] >= 0.5) == (found["quality"] == 1)).mean() > 0.97
    toxic = found["toxic_score"] >= 0.5
    assert toxic[found["toxic"] == 1].mean() > 0.75 and toxic[found["toxic"] == 0].mean() < 0.02


def test_no_labelled_document_is_taught(spark):
    docs, labels = queries.table(spark, SF, "documents"), queries.table(spark, SF, "labels")
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.lit("m").alias("meta"))
    marked = labels.select(F.col("doc_id").alias("id")).distinct()
    known = {r["id"] for r in marked.collect()}
    pool = quality.unlabelled_pool(rows.unionAll(rows), marked, 300).collect()
    ids = [r["id"] for r in pool]
    assert len(ids) == len(set(ids)) == min(300, docs.count() - len(known)) and not known & set(ids)
    assert sorted(r["id"] for r in quality.unlabelled_pool(rows.repartition(7), marked, 300).collect()) == sorted(ids)


def test_quality_odd(spark, table, odd_rows):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 1), (7, 0, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.score(table(odd_rows), quality.fit(table(odd_rows), labels)).count() == len(odd_rows)
    none = quality.fit(table([]), labels)
    assert {r["quality_score"] for r in quality.score(table(odd_rows), none).collect()} == {0.5}


def edits_by_hand(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern):
        new = [i + 1]
        for j, t in enumerate(text):
            new.append(min(row[j] + (p != t), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_alignment():
    rng = random.Random(7)
    for _ in range(60):
        pattern = [rng.randrange(4) for _ in range(40)]
        copy = list(pattern)
        for _ in range(rng.randrange(5)):
            k = rng.randrange(len(copy))
            copy[k : k + 1] = rng.choice([[], [9], [copy[k], 9]])
        region = [5] * rng.randrange(3) + copy + [5] * rng.randrange(3)
        hit = decontaminate.aligned(np.array(pattern), np.array(region), 3)
        best = edits_by_hand(pattern, region)
        assert (hit[2] if hit else 4) == min(best, 4)


def test_leaks(spark, table, odd_rows):
    rng = random.Random(8)
    items = [(i, sentence(rng, n)) for i, n in enumerate((12, 30, 90, 14))] + [(4, None), (5, "short"), (0, None)]
    rows, bad = [], set()
    for i in range(60):
        text = sentence(rng, 100)
        if i % 3 == 0:
            item = items[i % 4][1]
            edited = item.upper().replace(" ", "\n") if i % 2 else item[:20] + "#" + item[20:]
            text, _ = text[:200] + " " + edited + " " + text[200:], bad.add(i)
        rows.append((i, text))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(table(rows), bench).collect()
    assert {r["doc_id"] for r in found if r["contaminated"]} == bad
    assert all({s["item_id"] for s in r["leaks"]} == {r["doc_id"] % 4} for r in found if r["contaminated"])
    assert decontaminate.find_leaks(table(odd_rows), bench).where("contaminated").count() == 0
    assert decontaminate.find_leaks(table([]), bench.limit(0)).count() == 0


@pytest.mark.parametrize("block", [decontaminate.BLOCK_CHARS, 30])
def test_short_items_are_found_as_words(spark, table, monkeypatch, block):
    """Items too short for q-grams, in one pass or in several; not within other words, and never across documents."""
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    items = spark.createDataFrame([
        (1, "What is the capital of France? Paris"), (2, "Yes, 42!"), (3, "x"), (4, "?!"), (5, "Ünïcode wörd"), (2, "Yes, 42!"),
    ], "item_id long, text string")
    rows = [
        (1, "He asked: what is the capital of  France?\nParis, she said."), (2, "yes 42"), (3, "Eyes 42, yes 421"), (4, "yes"), (5, "42"),
        (6, "the axis x-ray"), (7, "ein ünïcode, wörd"), (8, None), (9, ""), (10, "what is the capital of France paris"[1:]),
    ]
    found = decontaminate.find_leaks(table(rows), items).collect()
    assert {r["doc_id"]: sorted({x["item_id"] for x in r["leaks"]}) for r in found if r["leaks"]} == {1: [1], 2: [2], 6: [3], 7: [5]}
    span = next(r["leaks"][0] for r in found if r["doc_id"] == 1)
    assert rows[0][1][span["start"]:span["end"]] == "what is the capital of  France?\nParis" and span["edits"] == 0


def test_leaks_in_blocks(spark, table, monkeypatch):
    rng = random.Random(9)
    items = [(i, sentence(rng, 20)) for i in range(8)]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 200)
    found = decontaminate.find_leaks(table(items), spark.createDataFrame(items, "item_id long, text string"))
    assert all([s["item_id"] for s in r["leaks"]] == [r["doc_id"]] for r in found.collect())


URLS = {
    "http://Example.ORG/es/1?x": ("example.org", "/es/1", "example.org/es/", "block"),
    "https://a.example.org/en/12#t": ("a.example.org", "/en/12", "example.org/en/1", "block"),
    "http://x.org/": ("x.org", "/", "org/", "allow"), "http://xorg/": ("xorg", "/", None, None),
    "http://b.com/fr/": ("b.com", "/fr/", "com/fr/", "allow"), "http://b.com?q=/de/": ("b.com", "", None, None),
    "http://b.com#/de/": ("b.com", "", None, None), "no scheme": ("", "", None, None), None: ("", "", None, None), "": ("", "", None, None),
    "http://ÄB.org/é\n/": ("Äb.org", "/é\n/", "org/", "allow"), "a://b://c.com/de/": ("b:", "//c.com/de/", None, None),
}


def test_urls(spark):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)], "page_id long, url string, host string")
    weights = url_filter.train(url_filter.labelled_by_rules(pages, queries.URL_RULES))
    found = url_filter.judge_urls(pages, queries.URL_RULES, weights)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for r in found.collect():
        host, path, rule, verdict = URLS[r["url"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["score"] > 0.5 else "allow"))
    none = url_filter.train(pages.limit(0).select("url", F.lit(True).alias("blocked")))
    assert {r["verdict"] for r in url_filter.judge_urls(pages, [], none).collect()} == {"allow"}


def test_url_model_learns(spark):
    rows = [(f"http://{'spam' if k % 2 else 'good'}{k}.net/p{k}", bool(k % 2)) for k in range(200)]
    weights = url_filter.train(spark.createDataFrame(rows, "url string, blocked boolean"))
    test = spark.createDataFrame([(f"http://{'spam' if k % 2 else 'good'}x{k}.net/q", k % 2) for k in range(40)], "url string, y int")
    found = url_filter.judge_urls(test, [], weights).collect()
    assert np.mean([(r["verdict"] == "block") == r["y"] for r in found]) > 0.95


def test_neighbours_recall(spark):
    vectors = queries.table(spark, "/root/testdata/sf0.1", "embeddings")
    found = queries.op4_nearest_neighbours(spark, "/root/testdata/sf0.1").toPandas()
    rows = vectors.orderBy("vec_id").toPandas()
    ids, matrix = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), float)
    hits = 0
    asked = [i for i in ids if i % 20 == 0]
    for i in asked:
        score = matrix @ matrix[ids == i][0]
        score[ids == i] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]])
        own = found[found["query_id"] == i].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21))
        assert np.allclose(own["score"], [score[ids == v][0] for v in own["vec_id"]])
        hits += len(best & set(own["vec_id"]))
    assert hits / (20 * len(asked)) >= 0.9


@pytest.mark.parametrize("scale, dims", [(1, 16), (3, 32)])
def test_neighbours_among_copies(scale, dims):
    """A third of a shard's rows are equal, many more than a search holds."""
    import pyarrow as pa

    rng = np.random.default_rng(12)
    matrix = rng.normal(size=(3000, dims))
    hot = rng.permutation(3000)[:1000]
    matrix[hot] = scale * rng.normal(size=dims)
    shard = pa.table({"id": np.arange(3000), "vector": matrix.tolist()})
    found = neighbours._answers(20, neighbours.SEARCH_WIDTH)((), shard, shard.take(np.arange(0, 3000, 20))).to_pandas()
    copies, others = [], []
    for q in range(0, 3000, 20):
        score = (matrix * matrix[q]).sum(axis=1)
        score[q] = -np.inf
        best = np.lexsort((np.arange(3000), -score))[:20]
        own = list(found[found["query_id"] == q]["vec_id"])
        assert len(own) == len(set(own)) == 20 and q not in own
        (copies if q in hot else others).append(len(set(best) & set(own)) / 20)
    assert np.mean(copies) == 1 and np.mean(others) >= 0.97


def test_neighbours_of_a_full_shard():
    """Vectors without structure are the hardest for a graph."""
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(neighbours.SHARD_ROWS, 64))
    graph, found = neighbours.Graph(vectors), 0
    asked = rng.integers(0, len(vectors), 100)
    for i in asked:
        true = np.argsort(-(vectors @ vectors[i]), kind="stable")[:20]
        found += len(np.intersect1d(true, graph.nearest(vectors[i], neighbours.SEARCH_WIDTH)))
    assert found >= 0.9 * 20 * len(asked)


def test_neighbours_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [None, 1.0]), (8, [inf, 1.0]), (9, [1.0]), (None, [3.0, 0.0]), (2, [1.0, 1.0]), (20, [1.0, 5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest_neighbours(table, table.where("vec_id % 20 = 0"))
    got = [tuple(r) for r in found.orderBy("query_id", "rank").collect()]
    assert [g for g in got if g[0] == 0] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 2, 1.0), (0, 4, 20, 1.0)]
    assert neighbours.nearest_neighbours(table.limit(0), table).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" ▁aethion\n\x00é日🎉<s>", max_size=40))
def test_pieces_equal_the_library(vocabulary, text):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    cache = test_pieces_equal_the_library.__dict__
    if "ours" not in cache:
        cache["ours"] = (
            SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")),
            pieces.Encoder(vocabulary), pieces.Decoder(vocabulary),
        )
    library, encoder, decoder = cache["ours"]
    ids = library.encode(text, add_eos=True)
    assert encoder.encode(text) == ids
    assert decoder.decode(ids) == library.decode(ids)


def test_pieces_of_a_table(table, odd_rows, vocabulary):
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.decode(pieces.encode(table(odd_rows), vocabulary), vocabulary).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        assert r["ids"] == library.encode(r["text"] or "", add_eos=True)
        assert r["decoded"] == library.decode(r["ids"])
    assert pieces.encode(table([]), vocabulary).count() == 0


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_equals_sql(spark, name):
    rows, found = differences(spark, connect(SF), SF, queries.queries()[name], oracles.SQL[name])
    # A row for each document, or for each conversation.
    assert rows == (100 if name == "op13_conversation_repair" else 1000) and found == []


def test_pipeline_keeps_one_row_of_each_group(spark, table):
    rng = random.Random(13)
    texts = [sentence(rng, 80) for _ in range(5)]
    near = [f"{t} more" for t in texts]
    rows = [(1, texts[0]), (1, near[0]), (1, near[0]), (2, texts[1]), (2, texts[1]), (2, texts[1]),  # equal ids, repeated rows
            (None, texts[2]), (None, near[2]), (None, near[2]), (None, texts[3]), (9, near[3]), (8, texts[3]),  # null ids
            (1, texts[4]), (5, None), (5, ""), (6, "")]
    docs = table(rows)
    found = corpus_pipeline.remove_near_duplicates(spark, docs, SF)
    assert found.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in found.collect()]
    groups = [{texts[k], near[k]} for k in range(5)]
    assert [[i for i, t in kept if t in g] for g in groups] == [[1], [2], [None], [8], [1]]
    assert sorted((i, t or "") for i, t in kept if not t) == [(5, ""), (5, ""), (6, "")]


def test_pipeline(spark, tmp_path):
    stages, docs = [], queries.table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF)
        docs.write.parquet(os.path.join(tmp_path, str(len(stages))))
        docs = spark.read.parquet(os.path.join(tmp_path, str(len(stages))))
        if len(stages) < 4:
            assert docs.columns == before.columns
        stages.append({r[0] for r in docs.select("doc_id").collect()})
    items = [r["text"] for r in queries.table(spark, SF, "benchmark").collect()]
    third = spark.read.parquet(os.path.join(tmp_path, "2")).collect()
    leaked = {r["doc_id"] for r in third if any(t in r["text"] for t in items)}
    assert leaked and stages[3] == stages[2] - leaked
    assert stages[4] == stages[3] and len(stages[0]) >= 990
