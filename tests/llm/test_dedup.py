"""Line, suffix-array, near-duplicate and passage dedup against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import sentence
from tillstream.llm import line_dedup, near_dedup, passages, suffix_dedup
from tillstream.llm.components import components


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def lines_by_hand(rows):
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for i, text in rows:
        lines = text.split("\n") if text is not None else []
        gone = set()
        for p in range(len(lines) - 2):
            window = tuple(lines[p : p + 3])
            if window in seen:
                gone.update((p, p + 1, p + 2))
            seen.add(window)
        out[i, text] = (None if text is None else "\n".join(x for p, x in enumerate(lines) if p not in gone), len(gone))
    return out


def test_lines(table):
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice("abcd") for _ in range(rng.randrange(9)))) for i in range(60)]
    found = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(table(rows)).collect()}
    assert found == {i: v for (i, _), v in lines_by_hand(rows).items()}


def test_lines_odd(table, odd_rows):
    found = line_dedup.dedup_lines(table(odd_rows))
    assert found.columns == [c for c in table(odd_rows).columns if c != "text"] + ["text", "n_lines", "n_removed", "n_spans"]
    kept = {(r["doc_id"], r["text"]) for r in found.collect()}
    assert found.count() == len(odd_rows)
    assert (8, "a\nb\nc\nd") in kept and (9, "x") in kept and (1, None) in kept and (6, "") in kept
    assert found.where("row = 'row' and bucket = 'bucket'").count() == len(odd_rows)


def bytes_by_hand(rows):
    n = suffix_dedup.WINDOW
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + n] for _, b in texts for p in range(len(b) - n + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                gone[p : p + n] = True
        out.append((i, len(b), int(gone.sum()), bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [4000, 1])
def test_repeats(table, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(2)
    shared = [sentence(rng, 150) for _ in range(3)]
    rows = [(i, sentence(rng, rng.randrange(150)) + "é" + rng.choice(shared)[rng.randrange(60):] + sentence(rng, 40)) for i in range(20)]
    rows += [(30, shared[0] * 3), (31, "z" * 1500), (32, "ab" * 700), (33, None), (34, ""), (35, rows[0][1]), (35, rows[0][1])]
    found = suffix_dedup.remove_repeats(table(rows))
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in found.collect()), key=repr)
    assert got == bytes_by_hand(rows)


def test_texts_of_few_letters(table):
    """Each window is a piece of its own; they are cut out a few at a time, and equal ones are held once."""
    rows = [(1, "z" * 60_000), (2, "ab" * 20_000), (3, "z" * 399), (4, "é" * 30_000)]
    found = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(table(rows)).collect()}
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"]) for i, r in found.items()} == {
        1: (60_000, 60_000, 1), 2: (40_000, 40_000, 1), 3: (399, 0, 0), 4: (60_000, 60_000, 1)
    }


def test_maximal_repeats_are_groups():
    rng = random.Random(3)
    a, b = sentence(rng, 200).encode()[:500], sentence(rng, 200).encode()
    pieces = suffix_dedup._Pieces([b"1" + a + b"X" + b[:50], b"2" + a + b"Y" + b[:50], b"3" + a[:450]], np.ones(3, np.int64), np.ones(3, np.int64))
    found = {(n, len(w)) for n, w in suffix_dedup.maximal_repeats(pieces)}
    assert (500, 2) in found and (450, 3) in found


def components_by_hand(rows, words):
    texts = sorted(set(rows), key=repr)
    sets = []
    for _, t in texts:
        w = (t or "").lower().split()
        sets.append(frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(texts)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if sets[x] and 100 * both >= 80 * len(sets[x] | sets[y]):
                root[find(x)] = find(y)
    groups = defaultdict(list)
    for x in range(len(texts)):
        groups[find(x)].append(x)
    out = {}
    for group in groups.values():
        ids = [texts[x][0] for x in group if texts[x][0] is not None]
        for x in group:
            out[texts[x]] = (len(sets[x]), min(ids, default=None))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_near(table, odd_rows, words):
    rng = random.Random(4)
    base = [sentence(rng, 60).split() for _ in range(4)]
    rows = list(odd_rows)
    for i in range(100, 180):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(9)}"
        rows.append((i, " ".join(w)))
    found = near_dedup.near_duplicates(table(rows), words)
    expected = components_by_hand(rows, words)
    assert found.count() == len(rows)
    for r in found.collect():
        n, first = expected[r["doc_id"], r["text"]]
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (n, first, r["doc_id"] == first)


def test_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    for size in (1, 20, 300, 4000):
        for edits in (0, 1, size // 8, size):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            b = np.unique(np.concatenate([a[edits:], rng.integers(0, 1 << 63, edits).astype(np.uint64)]))
            bits = sum(int(x).bit_count() for x in (near_dedup.sketch(a) ^ near_dedup.sketch(b)).view(np.uint64))
            assert bits <= len(np.setxor1d(a, b)) and (edits or bits == 0)


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)]
    found = dict(rows_of(components(spark.createDataFrame(links, "u long, v long")), "node", "root"))
    assert found == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}


def test_passages(table, odd_rows):
    rng = random.Random(6)
    passage = sentence(rng, 60)
    edited = passage.split()
    edited[0] = edited[-1] = "other"
    rows = [(i, sentence(rng, 80) + " " + passage + " " + sentence(rng, 80)) for i in range(12)]
    rows += [(20, sentence(rng, 50) + " " + " ".join(edited) + " " + sentence(rng, 50))]
    rows += [(i, sentence(rng, 200)) for i in range(30, 40)]
    found = passages.repeated_passages(table(rows)).collect()
    hit = {r["doc_id"] for r in found if r["n_repeated"] >= passages.LENGTH}
    assert len(hit & {*range(12), 20}) >= 12  # one keeps it
    assert not hit & set(range(30, 40))
    odd = passages.repeated_passages(table(odd_rows))
    assert odd.count() == len(odd_rows)
    assert odd.where("doc_id in (5, 6) and n_repeated > 0").count() == 1


def test_passages_in_another_order(table):
    rng = random.Random(8)
    parts = [sentence(rng, 60) for _ in range(4)]
    rows = [(1, " ".join(parts)), (2, " ".join([parts[2], parts[0], parts[3], parts[1]]))]
    found = {r["doc_id"]: r["n_repeated"] for r in passages.repeated_passages(table(rows)).collect()}
    assert sorted(found.values()) == [0, 4 * (60 - passages.WORDS + 1)]


def test_compact_windows():
    rng = np.random.default_rng(1)
    values = rng.integers(1 << 30, 1 << 62, 300).astype(np.uint64)
    windows = passages.compact_windows(values)
    cover = {}
    for a, c, b in windows.tolist():
        for i in range(a, c + 1):
            for j in range(max(c, i + passages.LENGTH - 1), b + 1):
                assert (i, j) not in cover
                cover[i, j] = c
    for i in range(300):
        for j in range(i + passages.LENGTH - 1, 300):
            assert cover[i, j] == i + int((values[i : j + 1] >> np.uint64(28)).argmin())


@pytest.mark.parametrize("run", [
    line_dedup.dedup_lines, suffix_dedup.remove_repeats, near_dedup.near_duplicates, passages.repeated_passages,
])
def test_empty(table, run):
    assert run(table([])).count() == 0


def test_native_plan(table):
    plan = line_dedup.dedup_lines(table([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None


def test_windows_of_texts_one_after_the_other():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    values[220:300] = values[220]
    begins = np.array([0, 10, 10, 210, 400])
    together = np.stack(passages.text_windows(values, begins)[:3], axis=1)
    alone = [passages.compact_windows(values[i:j]) + i for i, j in zip(begins, begins[1:])]
    assert together.tolist() == np.concatenate(alone).tolist()


def test_signatures_are_those_of_all_passages():
    rng = np.random.default_rng(4)
    shingles = rng.integers(0, 60, 150).astype(np.uint64)
    functions = [passages.text_windows(passages.mix(shingles ^ s), np.array([0, 150])) for s in passages._SEEDS]
    _, place, low, high = passages.signatures(functions, [np.ones(len(f.c), bool) for f in functions])
    wanted = set()
    for i in range(150):
        for j in range(i + passages.LENGTH, 151):
            at = [i + int((passages.mix(shingles[i:j] ^ s) >> np.uint64(28)).argmin()) for s in passages._SEEDS]
            wanted.add((at[0], min(at), max(at)))
    assert set(zip(place.tolist(), low.tolist(), high.tolist())) == wanted


def test_copies_lose_their_whole_text(table):
    rng = random.Random(8)
    text = sentence(rng, 70)
    rows = [(1, text), (2, text), (2, text), (3, text), (4, sentence(rng, 30)), (5, sentence(rng, 30))]
    found = [(r["doc_id"], r["n_repeated"]) for r in passages.repeated_passages(table(rows)).collect()]
    lost = {i: n for i, n in found}
    assert len(found) == 6 and sorted(lost[i] for i in (1, 2, 3)) == [0, 66, 66] and lost[4] == lost[5] == 0


def met(*pairs):
    return [{"places": [{"place": p, "low": p, "high": p}], "others": [o]} for p, o in pairs]


@pytest.mark.parametrize("count", [50, 60, 70, 90])
def test_a_changed_middle_word_does_not_end_a_passage(count):
    rng = np.random.default_rng(count)
    n, words = count - passages.WORDS + 1, passages.WORDS
    passage, middle = rng.integers(0, 1 << 62, n), n // 2
    edited = passage.copy()
    edited[middle - words // 2 : middle - words // 2 + words] = rng.integers(0, 1 << 62, words)
    ours = np.concatenate([rng.integers(0, 1 << 62, 100), passage, rng.integers(0, 1 << 62, 80)]).astype(np.uint64)
    theirs = np.concatenate([rng.integers(0, 1 << 62, 30), edited, rng.integers(0, 1 << 62, 90)]).astype(np.uint64)
    for at in (3, n - 4):
        assert passages.passages(ours, theirs, met((100 + at, 30 + at))) == [(100, 100 + n)]
    ours[100:103] = 1  # too few are left of the shorter ones
    found = passages.passages(ours, theirs, met((104, 34)))
    assert found == ([] if count < 60 else [(103, 100 + n)])


def test_changed_passages_in_another_order():
    rng = np.random.default_rng(5)
    ours = rng.integers(0, 1 << 62, 224).astype(np.uint64)
    theirs = np.concatenate([ours[k * 56 : k * 56 + 56] for k in (2, 0, 3, 1)])
    theirs[[k * 56 + j for k in range(4) for j in range(26, 31)]] = 7
    found = passages.passages(ours, theirs, met(*((k * 56 + 5, at * 56 + 5) for k, at in enumerate((1, 3, 0, 2)))))
    assert set().union(*(range(a, b) for a, b in found)) == set(range(224))


def test_all_places_of_a_leader_are_compared(table):
    rows = []
    for k in range(24):
        rng = random.Random(k)
        far = [sentence(rng, 60, 100_000) for _ in range(4)]
        passage = sentence(rng, 60, 100_000).split()
        other = [f"x{w}" if j < 6 or j >= 54 else w for j, w in enumerate(passage)]  # too far from the passage
        rows += [(2 * k, " ".join([far[0], *other, far[1], *passage, far[2]])), (2 * k + 1, " ".join([*passage, far[3]]))]
    found = {r["doc_id"]: r["n_repeated"] for r in passages.repeated_passages(table(rows)).collect()}
    n = 60 - passages.WORDS + 1
    for k in range(24):  # the other one, without its ends, is a passage too
        assert (found[2 * k], found[2 * k + 1]) in ((0, n), (n, 0), (n + passages.LENGTH, 0))


def test_a_signature_has_one_row_with_all_its_places():
    import pyarrow as pa

    rng = random.Random(3)
    refrain = sentence(rng, 60, 100_000)
    text = " ".join([sentence(rng, 90, 100_000), refrain, sentence(rng, 90, 100_000), refrain])
    (_, shingles, begins), = passages.chunk_shingles(pa.array([text]), passages.WORDS)
    values = [passages._signed(passages.text_windows(passages.mix(shingles ^ s), begins).values) for s in passages._SEEDS]
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text]), pa.array([np.concatenate(values)])], ["ref", "text", "values"])
    rows = pa.Table.from_batches(passages._member_rows(iter([batch]))).to_pylist()
    assert len({r["sign"] for r in rows}) == len(rows)
    assert {b["place"] - a["place"] for r in rows if len(r["places"]) == 2 for a, b in [r["places"]]} == {150}


def test_a_common_line_is_compared_in_one_round(spark, monkeypatch):
    rng = random.Random(15)
    line, passage = sentence(rng, 12, 100_000), sentence(rng, 70, 100_000)
    texts = [(k, " ".join([sentence(rng, 60, 100_000), line, sentence(rng, 60, 100_000)])) for k in range(30)]
    texts += [(k, " ".join([sentence(rng, 60, 100_000), passage, sentence(rng, 60, 100_000)])) for k in (40, 41)]
    place = {"place": 62, "low": 61, "high": 63}
    rows = [(1, k, [place]) for k, _ in texts]  # the two with a passage follow others that have none
    counts, kept = [], passages.stored

    def stored(df, name):
        found = kept(df, name)
        if name == "pairs":
            counts.append(found.count())
        return found

    monkeypatch.setattr(passages, "stored", stored)
    state = spark.createDataFrame(rows, f"sign long, ref long, places {passages.PLACES}")
    for column, value in (("led", False), ("may", True)):
        state = state.withColumn(column, F.lit(value))
    found = passages._found(kept(state, "members"), spark.createDataFrame(texts, "ref long, text string"))
    spans = [tuple(r) for table in found for r in table.collect()]
    assert spans == [(41, 60, 126)]
    assert counts[0] == 31 and sum(counts) < 31 + 2 * 32  # not each with each, which are 496


def test_places_within_spans(spark):
    rng = random.Random(16)
    rows = []
    for _ in range(60):
        starts = sorted(rng.sample(range(200), rng.randrange(0, 9)))
        ends, end = [], 0
        for x in starts:
            end = max(end, x) + rng.randrange(1, 40)
            ends.append(end)
        lows = [rng.randrange(250) for _ in range(20)]
        spans, steps = list(zip(starts, ends)), [s for s in (8, 4, 2, 1) if s <= len(starts)]
        rows += [(spans, steps, (0, low, low + rng.randrange(5))) for low in lows]
    df = spark.createDataFrame(rows, f"spans {passages.SPANS}, steps array<int>, place struct<place:long,low:long,high:long>")
    found = [r[0] for r in df.select(passages._covered(F.col("place"))).collect()]
    assert found == [any(x <= low and high < y for x, y in spans) for spans, _, (_, low, high) in rows]


def test_widest_spans():
    rng = np.random.default_rng(9)
    for _ in range(200):
        n = int(rng.integers(1, 130))
        shared = np.repeat(rng.random(n) < rng.choice([0.7, 0.9, 0.97, 1]), rng.choice([1, 5]))[:n]
        total = np.concatenate([[0], np.cumsum(np.where(shared, 1, -passages.OUTWEIGH))])
        fits = [(x, y) for x in np.flatnonzero(shared) for y in np.flatnonzero(shared) + 1 if x < y and total[y] >= total[x]]
        outer = [(x, y) for x, y in fits if not any(a <= x and y <= b for a, b in fits if (a, b) != (x, y))]
        wanted = [(x, y) for x, y in outer if total[y] - total[x] >= passages.OUTWEIGH * max(passages.LENGTH - (y - x), 0)]
        assert list(zip(*passages._widest(shared))) == sorted(wanted)


def test_texts_of_one_repeated_word_are_compared_by_few_shifts(monkeypatch):
    shifts, alike = [], passages._alike

    def counted(ours, theirs, shift, *more):
        shifts.append(shift)
        return alike(ours, theirs, shift, *more)

    monkeypatch.setattr(passages, "_alike", counted)
    ours, theirs = np.full(400, 5, np.uint64), np.full(300, 5, np.uint64)
    places = [{"places": [{"place": p, "low": p, "high": p} for p in range(400)], "others": list(range(300))}]
    assert passages.passages(ours, theirs, places)[0][0] == 0
    once, shifts[:] = sorted(set(shifts)), []
    assert len(once) <= 700
    none = np.arange(400, dtype=np.uint64)  # nothing long is shared: no shift is judged
    assert passages.passages(none, np.arange(380, 700, dtype=np.uint64), places) == [] and shifts == []


def test_repeats_at_the_start_of_a_text(table):
    rng = random.Random(10)

    def letters(count):
        return "".join(rng.choice("ab") for _ in range(count))

    rows = []
    for k in range(12):  # the byte laid before a text's first piece is by chance that before the other occurrence
        passage = letters(420 + 20 * k)
        rows += [(2 * k, passage + letters(500)), (2 * k + 1, letters(500) + passage + letters(300))]
    found = suffix_dedup.remove_repeats(table(rows))
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in found.collect()), key=repr)
    assert got == bytes_by_hand(rows)


def test_a_window_without_a_byte_before_has_a_sign_of_its_own():
    rng = random.Random(11)
    a, b = sentence(rng, 200).encode()[:500], sentence(rng, 200).encode()
    bodies, before = [b[:450] + b"k", a + b"X", b"1" + b[450:600] + b"k" + a + b"Y"], np.array([0, 0, 1])
    pieces = suffix_dedup._Pieces(bodies, before, np.ones(3, np.int64))
    assert suffix_dedup._spans(pieces) == [[], [(0, 500)], [(152, 652)]]
