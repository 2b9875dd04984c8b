"""Each operator on small tables, against brute force, and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from greenledger.llm import (
    benchmark_leaks, components, fingerprints, languages, licences, near_dups, packing, personal_data,
    queries, repeated_passages, secrets, tables, toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k % 977}x{k // 31}" for k in range(30_000))
SOME = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
ODD = [
    (None, None, None, None, None), (None, SOME, "en", "s", 1), (1, None, "en", None, 0), (2, "", "en", "s", 0),
    (3, " \n\t ", None, "s", 4), (4, "one", "en", "s", 3), (5, SOME, "en", "s", 9), (6, SOME, "en", "s", 9),
    (6, SOME, "en", "s", 9), (7, LONG, "en", "s", 9), (8, "x" * 200_000, "en", "s", 9), (9, "1234 !!", "en", "s", 7),
]
#: Names that the operators use themselves.
CLASHING = ("key", "bucket", "digest", "bands", "root", "node", "range", "row", "at", "start", "length", "shard",
            "score", "features", "label", "grams", "gram", "rank", "base", "tokens", "own", "entities", "bin")


def table(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.lit("other") for c in CLASHING})


def doc_rows(spark, sf_dir):
    return [tuple(r) for r in tables.read(spark, sf_dir, "documents", "doc_id", "text").collect()]


def shingle_set(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute_components(rows, percent=85):
    sets = [(d, shingle_set(t)) for d, t in rows]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    a1, b1 = find(a), find(b)
                    root[max(a1, b1)] = min(a1, b1)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets}


def near_copies(n, seed=3):
    """Copies of one text with more and more changed words, and others."""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for d in range(n):
        words = list(base) if d % 3 else [f"o{d}_{k}" for k in range(60)]
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = f"new{d}"
        rows.append((d, " ".join(words)))
    return rows


def test_near_dups_equal_brute_force(spark, sf_dir):
    rows = doc_rows(spark, sf_dir)
    got = {r[0]: tuple(r)[1:] for r in queries.op1_near_dups(spark, sf_dir).collect()}
    assert got == brute_components(rows)


@pytest.mark.parametrize("block", [3, 1000])
def test_near_dups_of_a_large_group_in_blocks(spark, block):
    rows = near_copies(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in near_dups.near_duplicates(df, block_docs=block).collect()}
    assert got == brute_components(rows)


def test_near_dups_of_odd_rows(spark):
    got = collections.Counter(tuple(r) for r in near_dups.near_duplicates(table(spark, ODD)).select(
        "doc_id", "n_shingles", "component_id", "kept").collect())
    assert sum(got.values()) == len(ODD)
    assert got[(6, 11, 5, False)] == 2 and got[(5, 11, 5, True)] == 1 and got[(2, 0, 2, True)] == 1
    assert got[(None, 11, None, True)] == 1 and got[(4, 1, 4, True)] == 1
    kept = near_dups.deduplicated(table(spark, ODD))
    assert kept.count() == len(ODD) - 2 and set(kept.columns) == set(table(spark, ODD).columns)


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(20)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    df = spark.createDataFrame(links, "hi long, lo long")
    got = dict(tuple(r) for r in components.components(df).collect())
    assert got == {**{k: 0 for k in range(21)}, **{k: 100 for k in range(100, 140)}}


def brute_leaks(docs, items, least=0.8):
    known = {i: shingle_set(t) for i, t in items if len((t or "").split()) >= 5}
    out = collections.Counter()
    for d, t in docs:
        own = shingle_set(t)
        for i, s in known.items():
            if len(own & s) >= least * len(s):
                out[(d, i, len(s), len(own & s))] += 1
    return out


def test_leaks_equal_brute_force(spark, sf_dir):
    items = [tuple(r) for r in tables.read(spark, sf_dir, "benchmark", "item_id", "text").collect()]
    got = collections.Counter(tuple(r)[:4] for r in queries.op2_benchmark_leaks(spark, sf_dir).collect())
    assert got == brute_leaks(doc_rows(spark, sf_dir), items) and got


def test_leaks_in_long_texts_blocks_and_odd_rows(spark):
    rng = random.Random(5)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(rng.randrange(5, 90)))) for k in range(40)]
    items += [(90, None), (91, "too few words"), (92, items[0][1]), (None, items[1][1])]
    docs = [(d, " ".join([*LONG.split()[: rng.randrange(9000)], *items[d % 40][1].split(),
                          *LONG.split()[:rng.randrange(9000)]])) for d in range(30)] + [r[:2] for r in ODD]
    docs += [(50, " ".join(items[3][1].split()[: len(items[3][1].split()) // 2]))]  # half an item
    df, bench = table(spark, docs, "doc_id long, text string"), table(spark, items, "item_id long, text string")
    for size in (1 << 20, 2000):
        got = collections.Counter(tuple(r)[:4] for r in benchmark_leaks.leaks(df, bench, block_bytes=size).collect())
        assert got == brute_leaks(docs, items)
    held = {d for d, *_ in brute_leaks(docs, items)}
    assert benchmark_leaks.decontaminated(df, bench).count() == sum(d not in held for d, _ in docs)
    assert benchmark_leaks.leaks(df, bench.limit(0)).count() == 0


def test_personal_data_over_a_table(spark, sf_dir):
    docs = tables.read(spark, sf_dir, "documents", "doc_id", "text")
    found = personal_data.found(docs, "k")
    assert personal_data.collisions(found).count() == 0
    before = dict(tuple(r) for r in docs.collect())
    seen = {}
    for r in found.collect():
        text = before[r.doc_id]
        for e in r.entities:
            assert e.original in text and e.original != e.surrogate
            assert seen.setdefault((e.kind, e.original), e.surrogate) == e.surrogate
            assert r.text.count(e.surrogate) >= 1
        if not r.entities:
            assert r.text == text
    assert seen
    left = personal_data.found(found.select("doc_id", "text"), "other")
    assert not {e.original for r in left.collect() for e in r.entities} & {o for _, o in seen}


def test_personal_data_of_odd_rows(spark):
    df = table(spark, ODD)
    out = personal_data.replaced(df, "k")
    assert out.schema == df.schema
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert personal_data.replaced(df.limit(0), "k").count() == 0


def test_languages_of_held_out_rows(spark):
    rows = queries.op4_languages(spark, "/root/testdata/sf0.01").join(
        tables.read(spark, "/root/testdata/sf0.01", "documents", "doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_languages_of_odd_rows(spark):
    got = languages.predictions(table(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id}
    assert by[1] == by[2] == by[3] == by[9] == ("und", 0.0) and by[5][0] == "en"
    unlabelled = table(spark, [(1, "some text", None, None, 9)])
    assert languages.predictions(unlabelled).first()["lang_pred"] == "und"
    assert languages.predictions(unlabelled.limit(0)).count() == 0


def test_licences_of_planted_lines(spark):
    fill = "thnt erin ouat the and\nof thand erin"
    rows = [(k, f"{fill} {k}\nordinary line {k} of the text", None, None, 0) for k in range(60)]
    rows += [
        (100, f"{fill}\nReleased under the MIT License.\n{fill}", None, None, 0),
        (101, "licensed under the apache license version 2.0", None, None, 0),
        (102, f"Licensed under CC BY-NC 4.0.\n{fill}\nReleased under the MIT License.", None, None, 0),
        (102, f"Licensed under CC BY-NC 4.0.\n{fill}\nReleased under the MIT License.", None, None, 0),
        (None, "Released under the MIT License.", None, None, 0),
    ]
    got = collections.Counter(tuple(r) for r in licences.licences(table(spark, rows + ODD)).collect())
    assert sum(got.values()) == len(rows) + len(ODD)
    assert got[(100, 1, 0, "MIT")] == 1 and got[(101, 1, 0, "Apache-2.0")] == 1
    assert got[(102, 2, 0, "CC-BY-NC,MIT")] == 2 and got[(None, 1, 0, "MIT")] == 1
    assert all(got[(k, 0, 0, "")] >= 1 for k in range(60))


def test_licences_of_an_empty_table(spark):
    assert licences.licences(table(spark, ODD).limit(0)).count() == 0


def test_packing_places_every_token_once(spark, sf_dir):
    rows = doc_rows(spark, sf_dir) + [r[:2] for r in ODD]
    df = table(spark, rows, "doc_id long, text string")
    pieces = packing.packed(df, shard_pieces=50).collect()
    bins = collections.defaultdict(list)
    for p in pieces:
        bins[(p.shard, p.bin)].append(p)
    for own in bins.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert sum(p.length for p in own) == own[0].filled
        assert own[0].capacity == min(c for c in packing.CAPACITIES if c >= own[0].filled)
    want, got = collections.Counter(), collections.Counter()
    for d, t in rows:
        want[d] += len((t or "").encode()) + 1
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == want
    assert packing.sequences(packing.packed(df)).count() > 0
    assert packing.packed(df.limit(0)).count() == 0


ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def brute_secrets(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def test_secrets_equal_plain_patterns_and_add_random_strings(spark, sf_dir):
    rng = random.Random(9)
    signs = secrets.ALPHABET[:62]
    rows = doc_rows(spark, sf_dir) + [r[:2] for r in ODD]
    rows += [(1000 + k, f"é€𝒳 password = '{''.join(rng.choices(signs, k=30))}' ok") for k in range(300)]
    parts = "read write user name list count total value index order group table with from".split()
    rows += [(1500 + k, " ".join("_".join(rng.choices(parts, k=4)) for _ in range(20))) for k in range(50)]
    rows += [(2000, "x token=secret: abcdefghijklmnop API_KEY:\"short\" AKIAAKIA" + "Z" * 20),
             (2001, "free " + "".join(rng.choices(signs, k=40)) + " end"),
             (2002, "an_ordinary_identifier_name and thentionerenthatwhouon text")]
    df = table(spark, rows, "doc_id long, text string")
    got = collections.defaultdict(list)
    for r in secrets.digest(secrets.find_secrets(df)).collect():
        got[r.doc_id].append(r)
    for d, t in rows:
        base = brute_secrets(t or "")
        same = [r for r in got[d] if r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()]
        assert same, (d, base)
        for kind in secrets.KINDS:
            assert any(r[f"n_{kind}"] == base.count(kind) for r in same)
        assert set(filter(None, base.split(","))) <= set(same[0].spans.split(","))
    assert got[2001][0].spans == "markov:5:45" and got[2002][0].spans == ""
    assert secrets.digest(secrets.find_secrets(df.limit(0))).count() == 0


def brute_repeats(rows, width=13):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - width + 1):
            if d is not None:
                k = tuple(w[i : i + width])
                first[k] = min(first.get(k, d), d)
    out = collections.Counter()
    for d, w in words:
        stay = [True] * len(w)
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                stay[i : i + width] = [False] * width
        kept = [x for x, s in zip(w, stay, strict=True) if s]
        out[(d, len(w), len(w) - len(kept), b" ".join(kept).decode())] += 1
    return out


@pytest.mark.parametrize("hot", [repeated_passages.HOT, 2])
def test_repeats_equal_brute_force(spark, sf_dir, hot):
    rows = doc_rows(spark, sf_dir) + [r[:2] for r in ODD] + near_copies(40)
    rows += [(900 + k, f"a{k} " + "same words again and again " * 9 + f"z{k}") for k in range(20)]
    df = table(spark, rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in repeated_passages.without_repeats(df, hot_from=hot).collect())
    assert got == brute_repeats(rows)
    assert repeated_passages.without_repeats(df.limit(0)).count() == 0


def test_windows_of_equal_hash_but_other_words_are_told_apart(spark, monkeypatch):
    from greenledger.llm import wordhash

    rows = near_copies(12)
    df = spark.createDataFrame([(d, d, t) for d, t in rows], "doc_id long, key long, text string")
    pack = repeated_passages._pack(13, 5, 1, np.zeros(0, np.uint64))
    blocks = df.coalesce(1).mapInArrow(pack, repeated_passages.BLOCKS).toPandas()
    real = wordhash.window_hashes
    monkeypatch.setattr(wordhash, "window_hashes", lambda w, n: real(w, n) % np.uint64(3))
    ranges = repeated_passages._repeats(13)(blocks)
    removed = collections.defaultdict(set)
    for r in ranges.itertuples():
        removed[r.doc_id].update(range(int(r.low), int(r.high)))
    want = {d: n for d, _, n, _ in brute_repeats(rows) if n}
    assert {d: len(s) for d, s in removed.items()} == want


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op9_toxicity(spark, sf).collect()
    assert len(rows) == 1000
    label = {r.doc_id: r.toxic for r in tables.read(spark, sf, "labels", "doc_id", "toxic").collect()}
    held = sorted((r.score, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label)
    bad = [k for k, (_, y) in enumerate(held) if y]
    area = (sum(bad) - len(bad) * (len(bad) - 1) / 2) / (len(bad) * (len(held) - len(bad)))
    assert area >= 0.9
    for r in rows:
        assert r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1


def test_toxicity_of_odd_rows(spark):
    bad = [(100 + k, f"plain words here vile{k % 3} text {k}", None, None, 0) for k in range(40)]
    good = [(200 + k, f"plain words here nice text {k}", None, None, 0) for k in range(60)]
    labels = table(spark, [(d, int(d < 200)) for d, *_ in bad + good] + [(None, 1), (5, None), (1, 0)],
                   "doc_id long, toxic int")
    docs = table(spark, bad + good + ODD)
    got = toxicity.predictions(docs, labels).collect()
    assert len(got) == len(bad + good + ODD)
    model = toxicity.fit(docs, labels)
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema
    left = {r.doc_id for r in kept.select("doc_id").collect()}
    assert left == {d for d, *_ in good + ODD}
    by = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    (p,) = by[100].passages
    assert bad[0][1][p.start : p.end] == "vile0" and not by[200].passages
    none = toxicity.predictions(docs, labels.limit(0)).collect()
    assert all(r.score < 0.01 and r.predicted == 0 for r in none)
    assert toxicity.predictions(docs.limit(0), labels).count() == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_sketch(text, k=128, width=5):
    def h(value, seed):
        return xxhash.xxh64(value, seed=seed & ((1 << 64) - 1)).intdigest()

    words = [w for w in re.split("[ \x09-\x0d]+", text.lower()) if w]
    hashed = [h(w.encode(), 42) for w in words]
    out = set()
    for i in range(max(1, len(words) - width + 1) if words else 0):
        seed = 42
        for x in hashed[i : i + width]:
            seed = h(x.to_bytes(8, "little"), seed)
        out.add(signed(seed))
    return sorted(out)[:k]


def brute_likeness(a, b, k=128):
    union = sorted(set(a) | set(b))[:k]
    return len(set(a) & set(b) & set(union)) / len(union) if union else 1.0


def test_fingerprints_equal_brute_force(spark, sf_dir):
    rows = sorted((d, t or "") for d, t in doc_rows(spark, sf_dir) + [(r[0], r[1]) for r in ODD[2:8]] + [
        (5_000_000, "far away 𝒳𝒳𝒳 é"), (5_000_001, "next to it")] if d is not None)
    seen, ids = [], set()
    for d, t in rows:
        if d not in ids:
            seen.append((d, t))
            ids.add(d)
    df = table(spark, seen, "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(df).collect()}
    assert len(got) == len(seen)
    for k, (d, text) in enumerate(seen):
        after = seen[(k + 1) % len(seen)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, following = (brute_sketch(t) for t in (text, edited, after))
        r = got[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "-".join(f"{x & ((1 << 64) - 1):x}" for x in own)
        assert r.near_edited == pytest.approx(brute_likeness(own, changed))
        assert r.near_next == pytest.approx(brute_likeness(own, following))


def test_fingerprints_of_odd_rows(spark):
    got = fingerprints.edited_fingerprints(table(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.fingerprint)
    assert by[5] == by[6] and by[1] == by[2] == by[3] == {""}
    assert len({r.edited_sha256 for r in got if r.doc_id == 6}) == 2  # the first is followed by the second
    assert fingerprints.edited_fingerprints(table(spark, ODD).limit(0)).count() == 0


def test_sketches_merge_and_estimate(spark):
    words = LONG.split()
    rows = [(0, " ".join(words[:6000])), (0, " ".join(words[3000:9000])), (1, " ".join(words[:9000]))]
    df = fingerprints.with_sketch(spark.createDataFrame(rows, "grp long, text string"), "text", "s")
    merged = {r.grp: r.s for r in fingerprints.merge_groups(df, ["grp"], "s").collect()}
    assert merged[0] == merged[1]
    row = df.where("grp = 1").select(fingerprints.distinct_shingles(F.col("s")).alias("n")).first()
    assert abs(row.n - len(shingle_set(rows[2][1]))) < 0.3 * row.n
    two = df.where("grp = 0").select(F.collect_list("s").alias("l")).select(
        fingerprints.containment(F.col("l")[0], F.col("l")[1]).alias("c")).first()
    assert abs(two.c - 0.5) < 0.15
