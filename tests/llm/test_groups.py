"""Near-duplicate documents, fuzzy lines and repeated bytes against direct evaluation."""

import hashlib
import itertools
import os
import random
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from panelwise.llm import components, lines, packed, repeats, suffixes, superminhash
from panelwise.llm.common import settled


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, a, b):
        self.up[self.root(a)] = self.root(b)


def groups(rows, size):
    sets = [{tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if (w := words(t)) else set() for _, t in rows]
    union = Union(len(rows))
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            union.join(a, b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        low[union.root(i)] = min(low.get(union.root(i), doc), doc)
    return sorted((doc, len(sets[i]), low[union.root(i)], doc == low[union.root(i)]) for i, (doc, _) in enumerate(rows))


def test_near_duplicates_are_those_of_all_pairs(docs, rows):
    got = superminhash.near_duplicates(docs, 4).collect()
    assert sorted(tuple(r) for r in got) == groups(rows, 4)


def test_large_groups_go_through_sketches(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(300):
        copy = list(base)
        for _ in range(rng.randrange(0, 9)):
            copy[rng.randrange(len(copy))] = f"n{i}x{rng.randrange(1000)}"
        texts.append((i, " ".join(copy)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(tuple(r) for r in superminhash.near_duplicates(df, 4).collect()) == groups(texts, 4)


def test_close_pairs_that_are_not_linked_stay_in_their_tasks(spark, monkeypatch):
    """Copies of one template just below the threshold: far more pairs are tested than leave a task."""
    rng = random.Random(6)
    texts = []
    for i in range(160):
        copy = [f"w{k}" for k in range(300)]
        for at in rng.sample(range(300), 9 if i % 4 else 2):
            copy[at] = f"n{i}x{at}"
        texts.append((i, " ".join(copy)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    made = []
    monkeypatch.setattr(components, "settled", lambda df, purpose, settle=components.settled: made.append((purpose, settle(df, purpose))) or made[-1][1])
    assert sorted(tuple(r) for r in superminhash.near_duplicates(df, 4).collect()) == groups(texts, 4)
    assert [d for p, d in made if p == "found"][-1].count() < 160


def test_no_documents_make_no_groups(empty):
    assert superminhash.near_duplicates(empty).count() == 0
    assert superminhash.deduplicated(empty).columns == empty.columns


def test_one_of_each_group_stays_with_its_columns(docs, rows):
    kept = superminhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d, _, _, k in groups(rows, 5) if k})


def test_rows_without_id_and_texts_of_one_id_are_documents_of_their_own(spark):
    rng = random.Random(5)
    a, b, c, d, e, f = ([f"{k}{rng.randrange(10**6)}" for _ in range(80)] for k in "abcdef")
    near = lambda w: " ".join([*w[:40], "other", *w[41:]])
    a, b, c, d, e, f = (" ".join(w) for w in (a, b, c, d, e, f))
    given = [
        (None, a), (None, near(b.split())), (4, b), (None, c), (None, near(c.split())), (None, ""), (None, None), (None, " "), (8, ""),
        (1, d), (1, e), (2, near(e.split())), (2, f), (0, near(d.split())), (3, f), (3, f), (6, near(f.split())),
    ]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words(t)) else set() for _, t in given]
    union = Union(len(given))
    for i, j in itertools.combinations(range(len(given)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            union.join(i, j)
    members = {}
    for i in range(len(given)):
        members.setdefault(union.root(i), []).append(i)
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(given)], "doc_id long, text string, n int")
    kept = [r.n for r in superminhash.deduplicated(df).collect()]
    assert len(kept) == len(set(kept)) == len(members)
    for group in members.values():
        least = min((given[i][0] is None, given[i][0] or 0) for i in group)
        assert [(given[i][0] is None, given[i][0] or 0) for i in group if i in kept] == [least]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 200, 200))
    grams = np.concatenate([common, a, common, b])
    signature = superminhash.signatures(grams, np.array([0, 1000, 2000]), 256)
    assert abs((signature[0] == signature[1]).mean() - 800 / 1200) < 0.1
    one = superminhash.signatures(grams[:1], np.array([0, 1, 1]), 64)
    assert np.isfinite(one[0]).all() and np.isinf(one[1]).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    got = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.root for r in got} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def thinned(rows):
    order = sorted(((d, t) for d, t in rows), key=lambda r: r[0])
    seen, kinds = [], {}
    for d, t in order:
        for n, line in enumerate((t or "").split("\n")):
            if w := tuple(words(line)):
                kinds.setdefault(w, len(kinds))
                seen.append((d, n, w))
    names = list(kinds)
    hashes = lines.Lines(pa.array(["\n".join(" ".join(w) for w in names)])).simhash.view(np.uint64)
    union = Union(len(names))
    for i in range(len(names)):
        for j in (np.flatnonzero(np.bitwise_count(hashes[i + 1 :] ^ hashes[i]) <= lines.BITS_OFF) + i + 1).tolist():
            a, b = names[i], names[j]
            if 5 * abs(len(a) - len(b)) <= max(len(a), len(b)) and 5 * distance(a, b) <= max(len(a), len(b)):
                union.join(i, j)
    first = {}
    for d, n, w in seen:
        first.setdefault(union.root(kinds[w]), (d, n))
    gone = {(d, n) for d, n, w in seen if first[union.root(kinds[w])] != (d, n)}
    return {(d, None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone)) for d, t in rows}


def test_lines_stay_once_per_group(docs, rows):
    got = lines.deduplicated(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    assert {(r.doc_id, r.text) for r in got.collect()} == thinned(rows)


def test_table_rows_with_one_other_cell_are_linked(spark):
    rng = random.Random(7)
    rows = []
    for i in range(120):
        cells = [f"c{i}x{rng.randrange(10**6)}" for _ in range(4)]
        other = [*cells[:3], f"other{i}"]
        rows += [(2 * i, "| " + " | ".join(cells) + " |"), (2 * i + 1, "| " + " | ".join(other) + " |")]
    kept = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).filter("n_removed = 0")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 240, 2))


def edited(rng, line, times):
    line = list(line)
    for _ in range(times):
        at = rng.randrange(len(line))
        kind = rng.randrange(3)
        line[at : at + (kind < 2)] = [f"v{rng.randrange(300)}"] * (kind > 0)
    return line


def test_lines_are_linked_by_edit_distance_alone(spark):
    rng = random.Random(8)
    kinds = []
    for size in [*range(4, 31), 50, 80] * 4:
        base = [f"v{rng.randrange(300)}" for _ in range(size)]
        kinds += [base, edited(rng, base, size // 5), edited(rng, base, size // 5), edited(rng, base, size // 5 + 1)]
    order = rng.sample(range(len(kinds)), len(kinds))
    kinds = [tuple(kinds[i]) for i in order]
    union = Union(len(kinds))
    links = 0
    for (i, a), (j, b) in itertools.combinations(enumerate(kinds), 2):
        if 5 * abs(len(a) - len(b)) <= max(len(a), len(b)) and 5 * distance(a, b) <= max(len(a), len(b)):
            union.join(i, j)
            links += a != b
    first = {}
    for i in range(len(kinds)):
        first.setdefault(union.root(i), i)
    assert links > 200
    df = spark.createDataFrame([(i, " ".join(k)) for i, k in enumerate(kinds)], "doc_id long, text string")
    kept = lines.deduplicated(df).filter("n_removed = 0")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(first.values())


def test_counts_of_word_pairs_travel_in_few_rows():
    rng = np.random.default_rng(3)
    seen = [np.where(rng.random(lines.SLOTS) < 0.3, rng.integers(0, 1 << 40, lines.SLOTS), 0) for _ in range(3)]
    seen[0][: 5 * lines.SLOTS_A_ROW] = 0
    batches = [b for s in seen for b in lines._counts_sent(s)]
    assert sum(b.num_rows for b in batches) == 3 * lines.SLOTS // lines.SLOTS_A_ROW - 5
    total = np.zeros(lines.SLOTS, np.int64)
    for b in lines._counts_added(iter(batches)):
        total[b.column("slot").to_numpy()] += b.column("n").to_numpy()
    assert (total == sum(seen)).all()


def test_rows_travel_packed():
    rng = np.random.default_rng(7)
    columns = [rng.integers(0, 1 << 40, 3000), rng.integers(-(1 << 62), 1 << 62, 3000), rng.integers(0, 300, 3000), np.zeros(3000, np.int64)]
    batches = list(packed.dealt(([c[i : i + 700] for c in columns] for i in range(0, 3000, 700)), 5, 40, 2))
    values = [(p, v) for b in batches for p, v in zip(b.column("part").to_pylist(), b.column("rows").to_pylist())]
    assert sum(len(v) for _, v in values) < 3000 * 15  # as rows of longs they take 32 bytes each
    got = [(p, *r) for p, v in values for r in packed.unpacked(v).tolist()]
    assert sorted(got) == sorted((int(k) * 5 >> 40, *r) for k, r in zip(columns[0], np.stack(columns, axis=1).tolist()))
    (rows,) = (r for b in batches for r in packed.by_part(iter([b.slice(1, 1)])))
    assert list(rows) == [2] and rows[2][0].tolist() == packed.unpacked(values[1][1])[0].tolist()


def test_equal_groups_of_buckets_have_one_name():
    near = lambda a, b: np.abs(a[:, 2] - b[:, 2]) <= 2
    ids = {1: 10, 2: 12, 3: 14, 4: 30, 5: 31, 6: 90}  # 1 to 3 are connected, so are 4 and 5
    rows = [(7, i, v) for i, v in ids.items()] + [(9, i, ids[i]) for i in (1, 2, 3, 6)] + [(9, 1, 10), (11, 1, 10), (11, 2, 12)]
    kept, name = lines.partnered(np.array(rows), near)
    groups = {}
    for (bucket, i, _), n in zip(kept.tolist(), name.tolist()):
        groups.setdefault((bucket, n), set()).add(i)
    assert sorted(map(sorted, groups.values())) == [[1, 2], [1, 2, 3], [1, 2, 3], [4, 5]]
    assert len({n for _, n in groups}) == 3


def test_settled_tables_leave_no_shuffle_files(spark):
    def files():
        return sum("shuffle_" in f for top in tracked for _, _, names in os.walk(top) for f in names)

    tracked = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    before = files()
    kept = settled(spark.range(5000).repartition(4, "id"), "test")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and kept.count() == 5000


def test_no_lines(empty):
    assert lines.deduplicated(empty).count() == 0 and lines.thinned(empty).columns == empty.columns


def cut(rows):
    low, out = {}, []
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            low[b[i : i + 50]] = min(low.get(b[i : i + 50], d), d)
    for d, t in rows:
        b = (t or "").encode()
        away = bytearray(len(b))
        for i in range(len(b) - 49):
            if low[b[i : i + 50]] < d:
                away[i : i + 50] = b"\1" * 50
        runs = sum(1 for i, x in enumerate(away) if x and not (i and away[i - 1]))
        kept = bytes(x for x, gone in zip(b, away) if not gone)
        out.append((d, len(b), sum(away), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_bytes_go(docs, rows):
    assert sorted(tuple(r) for r in repeats.digest(docs).collect()) == cut(rows)


def test_no_bytes(empty):
    assert repeats.digest(empty).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 3, 20])
def test_suffix_arrays(letters):
    rng = random.Random(letters)
    for _ in range(40):
        text = [rng.randrange(1, letters + 1) for _ in range(rng.randrange(1, 200))] + [0]
        assert suffixes.suffix_array(np.array(text), 400).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


def test_windows_of_smaller_owners():
    rng = random.Random(4)
    for _ in range(60):
        length = rng.choice([8, 11])
        parts = list({bytes(rng.choice(b"ab") for _ in range(rng.randrange(length, 50))) for _ in range(rng.randrange(1, 9))})
        owner = np.array([rng.randrange(4) for _ in parts])
        at = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        low = {}
        for p, o in zip(parts, owner):
            for i in range(len(p) - length + 1):
                low[p[i : i + length]] = min(low.get(p[i : i + length], 9), o)
        want = [i + length <= len(p) and low[p[i : i + length]] < o for p, o in zip(parts, owner) for i in range(len(p))]
        assert repeats.earlier_windows(np.frombuffer(b"".join(parts), np.uint8), at, owner, length).tolist() == want


def test_stretches_take_room_by_rows_not_by_piece():
    rng = np.random.default_rng(5)
    size = rng.integers(0, 3000, 2600)
    at = np.concatenate([[0], np.cumsum(size)])
    data = rng.integers(97, 100, at[-1]).astype(np.uint8)
    tracemalloc.start()
    found = repeats.Stretches(data, at)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 30 * len(data)
    for i in [*range(20), *range(2580, 2600)]:
        alone, mine = repeats.Stretches(data[at[i] : at[i + 1]], np.array([0, size[i]])), found.row == i
        for c in ("windows", "anchor", "hash"):
            assert (getattr(found, c)[mine] == getattr(alone, c)).all()
        assert (found.start[mine] == alone.start + at[i]).all()


def test_word_pairs_are_counted_in_all_documents(docs, rows):
    seen = np.zeros(lines.SLOTS, np.int64)
    hashes, _ = lines.Lines(pa.array([t for _, t in rows], pa.string())).pairs()
    np.add.at(seen, (hashes % np.uint64(lines.SLOTS)).astype(np.int64), 1)
    known = seen > 0
    expected = np.zeros(lines.SLOTS, np.uint8)
    expected[known] = np.minimum(1 + 2 * np.log2(seen[known]), 63).astype(np.uint8)
    assert (lines._levels(lines._keyed(docs, "doc_id", "text")).value == expected).all()
