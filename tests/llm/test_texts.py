"""Mixing, chat, fingerprints, token counts, BPE, search and toxicity against direct evaluation."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
from compare import differences, duck
from tokenizers import Tokenizer

from panelwise.llm import bpe, chat, edits, mixing, oracle, queries, sampling, search, toxicity

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def wanted_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    rest, fixed, total = set(names), {}, 1.5 * sum(sizes.values())
    while rest:
        level = (total - sum(fixed.values())) / sum(weight[s] for s in rest)
        full = {s for s in rest if weight[s] * level > 2 * sizes[s]}
        if not full:
            break
        fixed.update({s: 2.0 * sizes[s] for s in full})
        rest -= full
    return {**fixed, **{s: weight[s] * level for s in rest}}


def test_mix(docs):
    given = docs.select("doc_id", "text", "source", "lang", "size")
    got = mixing.mix(given).collect()
    size = {(r.doc_id, len(words(r.text))): r.source for r in given.collect()}
    per, taken = Counter(), Counter()
    assert len(got) == given.count()
    for r in got:
        source = size[(r.doc_id, r.size)]
        per[source] += r.size
        taken[source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    target = wanted_targets(per)
    for r in got:
        assert math.isclose(r.target, target[size[(r.doc_id, r.size)]], rel_tol=1e-9, abs_tol=1e-9)
    assert all(abs(taken[s] - target[s]) <= 1 for s in per)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(given.repartition(5)).collect()))


def test_mix_order_holds_shares_early(docs):
    got = [r for r in mixing.mix(docs).collect() if r.first_slot is not None]
    early = Counter(r.target for r in got if r.first_slot < 0.2 * max(r.first_slot for r in got))
    assert len(early) > 10


def test_mix_of_nothing(empty, docs):
    assert mixing.mix(empty).count() == 0 and mixing.repeated(empty).columns == empty.columns
    assert mixing.mix(docs.filter("doc_id IN (9000, 9001)")).filter("taken = 0").count() == 2


def test_chat_is_as_in_sql(spark):
    assert differences(queries.op3_chat(spark, SF), duck(SF), oracle.OP3) == ""


def test_chat_reads_back_anything(spark):
    said = [(1, 0, "ro%0A\nle<|", "a<\\|b<|im_end|>\n<"), (1, 1, "assistant", "|<\\"), (None, 1, None, None), (1, 1, "assistant", "|<\\"), (2, None, "assistant", "é𝄞")]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    for r in chat.read_back(chat.formatted(chat.canonical(chat.records(df)))).collect():
        assert r.turns == r.read_turns and r.layout
        assert r.read_loss == "".join(t.text for t in r.turns if t.role == "assistant")
        assert r.formatted.count(chat.START) == len(r.turns)
    assert chat.digest(df.limit(0)).count() == 1


def test_chat_layouts(spark):
    records = [example.replace('""', '"x"') for example, _ in chat.LAYOUTS.values()] + ['{"other": 1}', '{"prompt": null, "response": "y"}']
    df = spark.createDataFrame([(r,) for r in records], "r string").selectExpr("parse_json(r) AS record")
    got = chat.canonical(df).collect()
    assert [r.layout for r in got] == [*chat.LAYOUTS, None, "prompt"]
    assert got[4].turns is None and [t.text for t in got[5].turns] == ["", "y"]


def jaccard(a, b):
    x, y = (Counter(words((t or "").lower())) for t in (a, b))
    both = set(x) | set(y)
    return sum(min(x[w], y[w]) for w in both) / sum(max(x[w], y[w]) for w in both) if both else 1.0


def test_fingerprints(docs, rows):
    got = {}
    for r in sampling.digest(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    order = sorted({(d, t or "") for d, t in rows})
    by_text, errors = {}, []
    for (d, t), (_, after) in zip(order, [*order[1:], order[0]]):
        n = len(t)
        changed = t[: n - n // 2] + after[: n // 2]
        assert len(got[d]) == sum(1 for e, _ in rows if e == d)
        for r in got[d]:
            assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(changed.encode()).hexdigest())
            assert by_text.setdefault(t, r.fingerprint) == r.fingerprint
        errors += [r.near_edited - jaccard(t, changed), r.near_next - jaccard(t, after)]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.12


def test_likeness_deviates_as_64_places_do(spark):
    rows = []
    for i in range(300):
        own = [[f"{side}{i}x{k}" for k in range(20)] for side in "abc"]
        rows += [(2 * i, " ".join(own[0] + own[1] + [f"d{i}x{k}" for k in range(20)])), (2 * i + 1, " ".join(own[0] + own[2] + [f"d{i}x{k}" for k in range(20)]))]
    found = {r.k: r.places for r in sampling.fingerprints(spark.createDataFrame(rows, "k long, text string"), ["k"]).collect()}
    errors = [np.mean(np.array(found[2 * i]) == np.array(found[2 * i + 1])) - 0.5 for i in range(300)]
    assert {len(p) for p in found.values()} == {sampling.SAMPLES} and sampling.SAMPLES >= 64
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.075


def test_limited_draws_take_what_all_draws_take(spark):
    texts = ["", "one", "a b a", " ".join(f"w{i % 40}" for i in range(90)), " ".join(f"v{i}" for i in range(200))]
    frame = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    every = {r.k: r.places for r in sampling._drawn(frame, ["k"], 64, None).collect()}
    lost = {}
    for limit in (0.5, sampling.SURELY):
        found = sampling._drawn(frame, ["k"], 64, limit).collect()
        lost[limit] = [r.k for r in found if r.lost]
        assert {r.k: r.places for r in found if not r.lost} == {k: p for k, p in every.items() if k not in lost[limit]}
    assert sorted(lost[0.5]) == [1, 2, 3, 4] and not lost[sampling.SURELY]
    assert {r.k: r.places for r in sampling.fingerprints(frame, ["k"]).collect()} == every


def test_lost_places_are_drawn_again(spark, monkeypatch):
    frame = spark.createDataFrame([(0, ""), (1, "a b a"), (2, " ".join(f"v{i}" for i in range(50)))], "k long, text string")
    every = {r.k: r.places for r in sampling._drawn(frame, ["k"], 64, None).collect()}
    monkeypatch.setattr(sampling, "SURELY", 0.5)
    assert {r.k: r.places for r in sampling.fingerprints(frame, ["k"]).collect()} == every


def test_no_fingerprints(empty):
    assert sampling.digest(empty).count() == 0


def test_token_counts_follow_edits(monkeypatch):
    monkeypatch.setattr(edits, "LEAF", 3)
    counter = edits.Counter(edits.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    rng = random.Random(5)
    some = lambda n: "".join(rng.choice("ab 1\n.'s é  ") for _ in range(n))
    for _ in range(300):
        text = some(rng.randrange(0, 60))
        tree = edits.Tree(counter, text)
        for _ in range(4):
            place, length, new = rng.randrange(-2, 70), rng.randrange(0, 20), some(rng.randrange(0, 8))
            at = min(max(0, place), len(text))
            text = text[:at] + new + text[at + length :]
            tree.edit(place, length, new)
            assert tree.text == text and tree.total == len(counter.encoding.encode_ordinary(text))


def test_edits_encode_little(spark, docs, empty):
    got = queries.op5_edits(spark, SF).collect()
    long = [r for r in got if r.edited_chars > 20_000]
    assert all(r.encoded_chars < 0.3 * r.edited_chars for r in long)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert edits.counted(edits.edited(docs), path, public_tokenizers.PATTERN).count() == docs.count()
    assert edits.counted(edits.edited(empty), path, public_tokenizers.PATTERN).count() == 0


def test_bpe_is_the_librarys(spark, docs, rows, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = ["<|endoftext|>x<|STARTOFTEXT|> <|startoftext|>", "ΑΣ ΣΑΣ. Σ", "a\x1cb\x85d e", "don't I'LL we've'S ½ Ⅷ", "日本語 🙂👩‍👧 İ", "é Å", "y" * 700]
    more = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = bpe.digest(docs.select("doc_id", "text").unionByName(more), path, words=500, keep_ids=True).collect()
    texts = Counter()
    for r in got:
        texts[(r.doc_id, tuple(r.ids))] += 1
    want = Counter()
    for d, t in [*rows, *enumerate(odd)]:
        want[(d, tuple(library.encode(t or "", add_special_tokens=False).ids))] += 1
    assert texts == want
    for r in got:
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(r.ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digest(empty, path, words=10).count() == 0


def test_automaton_is_minimal_and_numbers_words():
    names = sorted({w.encode() for w in ("tap", "taps", "top", "tops", "stop", "stops", "é", "")})
    arrays = bpe.automaton(names)
    data = np.frombuffer(b"".join([*names, b"tapss", b"sto"]), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(w) for w in [*names, b"tapss", b"sto"]])])
    assert bpe.numbers(arrays, data, at).tolist() == [*range(len(names)), -1, -1]
    assert len(arrays["final"]) == 8


def test_search_finds_what_scoring_everything_finds(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(search, "QUERY_TERMS", 4000)
    asked = docs.filter("doc_id % 20 = 0").selectExpr("doc_id AS query_id", "text")
    got = sorted((r.query_id, r["rank"], r.doc_id, r.score) for r in search.search(docs, asked, 5).collect())
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    held = [(d, Counter(words(low(t)))) for d, t in rows]
    df = Counter(w for _, c in held for w in c)
    mean = sum(sum(c.values()) for _, c in held) / len(held)
    want = []
    for q, terms in {(d, tuple(c.items())) for d, c in held if d % 20 == 0}:
        scores = []
        for d, c in held:
            size = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(n * math.log(1 + (len(held) - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + size) for w, n in terms if w in c)
            if s > 0:
                scores.append((-round(s, 9), d))
        want += [(q, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:5])]
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert all(math.isclose(g[3], w[3], rel_tol=1e-6) for g, w in zip(got, sorted(want)))
    assert search.search(empty, asked, 5).count() == 0 and search.search(docs, asked.limit(0), 5).count() == 0


def test_search_over_many_shards_sends_few_rows_and_finds_the_same(spark, monkeypatch):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(400)], k=rng.randint(1, 60))) for _ in range(600)]
    texts += [texts[5]] * 40 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    asked = docs.filter("doc_id % 30 = 5").selectExpr("doc_id AS query_id", "text")
    whole = sorted(map(tuple, search.search(docs, asked, 3).collect()))
    leaving = []
    searched = search._searched
    monkeypatch.setattr(search, "_searched", lambda *a: leaving.append(searched(*a)) or leaving[-1])
    monkeypatch.setattr(search, "SHARD_BYTES", 1500)
    monkeypatch.setattr(search, "ROUND", 6)
    found = sorted(map(tuple, search.search(docs, asked, 3).collect()))
    assert found == whole and len(found) == 3 * 22
    assert sum(x.count() for x in leaving) < 22 * 3 * 20  # of the 60 shards each has three documents for almost every query


def test_segments_hold_the_best_one():
    rng = random.Random(3)
    for _ in range(200):
        places = sorted(rng.sample(range(60), rng.randrange(1, 15)))
        hits = [(p, rng.choice([0.5, 1.0, 2.0])) for p in places]
        walk = [dict(hits).get(i, -0.25) for i in range(60)]
        best = max(sum(walk[i:j]) for i in range(60) for j in range(i + 1, 61))
        found = toxicity.segments(hits, 0.25)
        assert math.isclose(max(s for _, _, s in found), best)
        assert all(math.isclose(sum(walk[a : b + 1]), s) for a, b, s in found)


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    right = [r for r in out if r.predicted == r.toxic]
    assert len(right) >= 0.95 * len(out)
    assert sum(r.predicted for r in out if r.toxic) >= 0.75 * sum(r.toxic for r in out)
    assert sum(r.predicted for r in out if not r.toxic) <= 2


def test_toxicity_of_odd_inputs(spark, docs, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.digest(docs, labels).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    assert toxicity.digest(empty, labels).count() == 0
    assert {r.score for r in toxicity.digest(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.accepted(docs, labels).columns == docs.columns


def test_toxicity_learns_from_all_labels_not_held_out(spark):
    many = spark.range(100_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS toxic")
    got = toxicity.labelled(many)
    assert got.count() == many.filter("crc32(cast(doc_id AS string)) % 3 <> 1").count() > 50_000


def test_many_labels_meet_documents_in_a_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "vile awful words" if i % 2 else "kind calm words") for i in range(300)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic")
    monkeypatch.setattr(toxicity, "PRIOR", 1.0)
    few = toxicity.fitted(docs, labels)
    monkeypatch.setattr(toxicity, "BROADCAST", 10)
    many = toxicity.fitted(docs, labels)
    assert few.scores and (many.scores, many.curve, many.bare) == (few.scores, few.curve, few.bare)


def test_pipeline(spark):
    import corpus_pipeline
    from panelwise.llm.common import settled

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "bpe"]
    before = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = settled(stage(spark, before, SF), "test-stage")
        assert after.columns == docs.columns
        kept, had = {r.doc_id for r in after.collect()}, {r.doc_id for r in before.collect()}
        assert kept <= had and len(kept) > 0.3 * len(had)
        before = after
    ids = Counter(r.doc_id for r in before.collect())
    assert max(ids.values()) <= 2
    assert Counter(r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, before, SF).collect()) == ids


def test_stages_keep_columns_of_any_name(spark, docs):
    import corpus_pipeline

    names = ["n_lines", "n_removed", "_text", "_late", "_row", "score", "evidence", "passages", "_times", "_copy", "_id", "node", "root", "kept"]
    odd = docs.select("doc_id", "text", "lang", "source", "n_chars").selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    lost = spark.createDataFrame([(None, "alone without an id", None, None, None, *["x"] * len(names))], odd.schema)
    before = odd.unionByName(lost)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, SF).collect(), before.schema)
        assert after.columns == odd.columns, name
        assert after.filter("doc_id IS NULL").count() >= 1, name
        kept = after.filter("doc_id IS NOT NULL")
        assert kept.filter(" OR ".join(f"`{n}` <> concat('{n}', doc_id)" for n in names)).count() == 0, name
        before = after


def test_stages_of_nothing(spark, empty):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_toxicity_counts_in_bounded_room(spark, docs, monkeypatch):
    few = docs.selectExpr("text", "cast(coalesce(doc_id, 0) % 2 AS int) AS toxic").coalesce(1)
    every = sorted(toxicity._counted(few, None).collect())
    monkeypatch.setattr(toxicity, "WORDS_HELD", 20)
    monkeypatch.setattr(toxicity, "FEATURES_HELD", 100)
    monkeypatch.setattr(toxicity, "pieces", lambda batches: (b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    assert sorted(toxicity._counted(few, None).collect()) == every and len(every) > 1000


def test_toxicity_sends_a_kept_text_once(docs):
    got = toxicity.scored(docs, toxicity.Model({}, 1.0), ["doc_id", "text"])
    assert "_text" not in got._jdf.queryExecution().analyzed().toString()
    assert sorted(map(repr, got.select("doc_id", "text").collect())) == sorted(map(repr, docs.select("doc_id", "text").collect()))
    assert toxicity.scored(docs, toxicity.Model({}, 1.0), ["doc_id"]).columns == ["doc_id", "score", "evidence", "passages"]
