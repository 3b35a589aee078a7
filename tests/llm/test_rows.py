"""Operators on documents against brute force, with the awkward rows of each kind."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import plan_of
from millrace.llm import common, components, minhash, mixing, packing, sharding, tokenfiles, tokens
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, source string, size int, shard int, component_id string, key binary"
WORDS = [f"w{k}" for k in range(3000)]


def made(spark, rows):
    """Documents with further columns named like the operators' own."""
    return spark.createDataFrame([(i, t, s, -1, -1, "x", b"y") for i, t, s in rows], DOCS)


def corpus():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    rows, base = [], text(150).split()
    for _ in range(60):  # near copies, some linked and some not
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(150)] = rng.choice(WORDS)
        rows.append(" ".join(copy))
    chain = text(200).split()
    for step in range(12):  # each linked to the next one only
        rows.append(" ".join(chain))
        for k in range(3):
            chain[(step * 17 + k) % 200] = f"new{step}x{k}"
    rows += [rows[0]] * 80 + [rows[0].upper().replace(" ", "\t\n")]
    rows += [text(rng.choice([1, 3, 4, 5, 6, 40, 300])) for _ in range(80)]
    rows += ["hello <|endoftext|> world", "<|startoftext|><|endoftext|>"]
    rows += ["one two", "one two", "ONE two", "two one", "", "  \n", None, None, "é É", "É é"]
    rows.append(text(20_000))
    rng.shuffle(rows)
    return [(k * 7 % 1009, t, [None, "a", "b", "é", ""][k % 5]) for k, t in enumerate(rows)]


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def linked_components(rows, percent):
    sets = {i: shingle_set(t) for i, t, _ in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i in sets if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, work, percent, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)  # several blocks in a bucket
    rows = corpus()
    found = minhash.near_duplicates(made(spark, rows), work, percent=percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect()}
    assert got == linked_components(rows, percent)


def test_a_node_has_one_text_however_many_rows(spark, work):
    """3,000 copies of one row, id and all, and 20 near copies."""
    rng = random.Random(1)
    base = [rng.choice(WORDS) for _ in range(120)]
    near = [" ".join([*base[:k * 5], "changed", *base[k * 5 + 1 :]]) for k in range(20)]
    rows = [(7, " ".join(base), "a")] * 3000 + [(100 + k, t, "a") for k, t in enumerate(near)]
    stored = common.keep(minhash.sketches(made(spark, rows)), work, "stored")
    nodes = stored.groupBy("node").agg(F.min("row_no").alias("row_no"), F.first(F.struct("bands", "signature", "n_shingles")).alias("kept"))
    buckets, _ = minhash._buckets(nodes, work)
    assert minhash._texts(stored, nodes, buckets).count() == 21
    found = minhash.near_duplicates(made(spark, rows), work.__class__(spark, "whole")).collect()
    assert len(found) == 3020 and {r["component_id"] for r in found} == {7}


def test_slots_of_repeated_rows_are_given_in_parts(spark, work, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 500)
    placed = spark.range(6000).selectExpr("0 as shard", "1L as key", "5L as doc_id", "id as row_no")
    found = sharding._with_slots(placed, 1).collect()
    assert sorted(r["slot"] for r in found) == list(range(6000))
    assert max(Counter(r["part"] for r in found).values()) < 700


def test_near_duplicates_without_ids_and_with_repeated_rows(spark, work):
    text = "a b c d e f g"
    rows = [(None, text, "s"), (5, text, "s"), (5, text, "s"), (3, text, "s"), (9, "z y x", "s"), (9, "other words", "s")]
    found = minhash.near_duplicates(made(spark, rows), work).collect()
    assert Counter(map(tuple, found)) == Counter(
        [(None, 3, None, True), (5, 3, 3, False), (5, 3, 3, False), (3, 3, 3, True), (9, 1, 9, True), (9, 1, 9, True)]
    )


def test_estimate_counts_equal_fields(spark):
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**32, minhash.MINIMA, dtype=np.uint32)
    other = one.copy()
    other[:30] += 1
    a, b = (minhash.signature(x).tolist() for x in (one, other))
    frame = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    value = frame.select(minhash.estimate(F.col("a"), F.col("b"))).first()[0]
    assert value == pytest.approx((82 / 112 - 1 / 16) / (15 / 16))


def test_components(spark, work):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(links, "a long, b long"), work).collect()}
    root = {n: n for link in links for n in link if link[0] != link[1]}
    for _ in root:
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert found == root


def minimax(sizes, shards):
    """Least largest sum of a cut of the list into so many parts, by dynamic programming."""
    best = [0, *np.cumsum(sizes).tolist()]
    sums = np.concatenate([[0], np.cumsum(sizes)])
    for _ in range(shards - 1):
        best = [min((max(best[k], int(sums[n] - sums[k])) for k in range(n + 1))) for n in range(len(sizes) + 1)]
    return best[-1]


@pytest.mark.parametrize("cell_bits", [3, 6, 16])
@pytest.mark.parametrize("shards", [1, 3, 8])
def test_sharding(spark, work, shards, cell_bits, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_BITS", cell_bits)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 10)
    rows = corpus()
    placed = sharding.shard_by_bytes(made(spark, rows), work, shards=shards).collect()
    assert sorted(r["doc_id"] for r in placed) == sorted(i for i, _, _ in rows)
    text_of = {i: t for i, t, _ in rows}
    shard_of, slots, sums = {}, defaultdict(list), Counter()
    for r in placed:
        text = text_of[r["doc_id"]]
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
        assert r["size"] == len((text or "").encode()) + 16
        assert r["text_crc32"] == zlib.crc32((text or "").encode())
        slots[r["shard"]].append(r["slot"])
        sums[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and max(slots) < shards
    # The largest groups alone, the rest cut as well as any cut in their order.
    keys = {r["text"]: r["key"] for r in made(spark, rows).select("text", sharding.hash63(F.col("text")).alias("key")).collect()}
    groups = Counter()
    for _, text, _ in rows:
        groups[text] += len((text or "").encode()) + 16
    alone, rest = 0, sum(groups.values())
    for _, size in groups.most_common(shards):
        if size * (shards - alone) <= rest:
            break
        alone, rest = alone + 1, rest - size
    giants = {t for t, _ in groups.most_common(alone)}
    ordered = [groups[t] for t in sorted(groups, key=keys.get) if t not in giants]
    assert max(sums[s] for s in range(shards - alone)) == minimax(ordered, shards - alone)


def test_sharding_of_nothing(spark, work):
    assert sharding.shard_by_bytes(made(spark, []), work).collect() == []


def expected_mixture(rows):
    sizes = Counter()
    count = lambda t: len((t or "").split())
    for _, text, source in rows:
        sizes[source] += count(text)
    ordered = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: k % 3 + 1 for k, s in enumerate(ordered)}
    total, targets, full = sum(sizes.values()), {}, set()
    while len(full) < len(ordered):
        rest = total - sum(3 * sizes[s] for s in full)
        share = rest / sum(weights[s] for s in ordered if s not in full)
        over = {s for s in ordered if s not in full and share * weights[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    for s in ordered:
        targets[s] = 3.0 * sizes[s] if s in full else share * weights[s]
    return sizes, targets


def test_mixing(spark, work):
    rows = [(i, t, "a" if i % 3 == 0 else s) for i, t, s in corpus()]
    mixed = mixing.mix(made(spark, rows), work, carry=["doc_id", "size"])
    assert "Python" not in plan_of(mixed) and "Arrow" not in plan_of(mixed)
    got = mixed.collect()
    sizes, targets = expected_mixture(rows)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["row"]["size"] == -1
        assert r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] in [r["size"] * k for k in range(4)]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(got) == len(rows) and sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source]
    again = mixing.mix(made(spark, rows), work.__class__(spark, "again")).select("doc_id", "taken").collect()
    assert sorted(map(tuple, again)) == sorted((r["doc_id"], r["taken"]) for r in got)


def test_mixing_without_words(spark, work):
    assert mixing.mix(made(spark, []), work).collect() == []


def test_mixing_of_empty_texts(spark, work):
    got = mixing.mix(made(spark, [(1, None, None), (2, "", "a"), (None, " ", "b")]), work).collect()
    assert {(r["target"], r["taken"]) for r in got} == {(0.0, 0)} and len(got) == 3


def test_a_larger_budget_keeps_a_smaller_ones_documents(spark, work):
    rows = [(k, " ".join(["w"] * (k % 7 + 1)), "a") for k in range(400)]
    sizes = made(spark, rows).select(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size"), mixing.document_hash(F.col("doc_id"), F.col("text")).alias("hash")
    )
    taken = []
    for target in (100.0, 500.0, 900.0):
        aims = spark.createDataFrame([("a", 1594, target)], "source string, source_size long, target double")
        last = mixing.thresholds(sizes, aims, work.__class__(spark, "nested"), 3).first()["last_hash"]
        taken.append({r["doc_id"] for r in sizes.where(F.col("hash") <= last).collect()})
    assert taken[0] < taken[1] < taken[2]


def definition(name):
    return tokens.read_tokenizer(public_tokenizers.path(name))


def library_ids(name, text, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_packing(spark):
    rows = corpus()
    pieces = packing.cut_documents(made(spark, rows), definition("byte_bpe_50k.json"))
    packed = packing.pack(pieces, groups=3, seed=1).cache()
    texts = {i: library_ids("byte_bpe_50k.json", t, 0) for i, t, _ in rows}
    got, places = defaultdict(dict), defaultdict(list)
    for r in packed.collect():
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        got[r["doc_id"]][r["start"]] = ids
        assert len(ids) == r["length"] and r["doc_tokens"] == len(texts[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(r["ids"])
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {i: sum((p[s] for s in sorted(p)), []) for i, p in got.items()} == texts
    padding = 0
    for taken in places.values():
        end = 0
        for offset, length in sorted(taken):
            assert offset == end
            end += length
        assert end <= 1024
        padding += 1024 - end
    whole = sum(map(len, texts.values()))
    assert padding <= 3 * 1024 + 0.01 * whole
    assert {r["sequence_id"]: r["length"] for r in packing.sequences(packed).collect()} == {
        s: sum(n for _, n in taken) for s, taken in places.items()
    }
    again = packing.pack(packing.cut_documents(made(spark, rows[::-1]), definition("byte_bpe_50k.json")), groups=3, seed=1)
    key = ["doc_id", "start", "sequence_id", "offset"]
    assert Counter(map(tuple, again.select(key).collect())) == Counter(map(tuple, packed.select(key).collect()))


@pytest.mark.parametrize("with_ids", [True, False])
def test_documents_are_cut_only_where_it_saves_sequences(spark, with_ids):
    rng = random.Random(3)
    mixed = [(k, "a b " * rng.randrange(2, 250), "s") for k in range(400)]
    pieces = packing.cut_documents(made(spark, mixed), definition("byte_bpe_50k.json"), with_ids=with_ids)
    found = packing.pack(pieces).collect()
    assert len(found) == 400 and "parts" not in found[0].asDict()
    # 601 ids each: whole, two of them never share a sequence.
    alike = [(k, "a b " * 300, "s") for k in range(100)]
    pieces = packing.cut_documents(made(spark, alike), definition("byte_bpe_50k.json"), with_ids=with_ids)
    found = packing.pack(pieces).collect()
    total = sum(r["length"] for r in found)
    assert total == 100 * found[0]["doc_tokens"]
    assert len({r["sequence_id"] for r in found}) <= -(-total // 1024) + 1
    for r in found:
        assert r["length"] in (512, 256, 601, 89, 345, found[0]["doc_tokens"] - 512, found[0]["doc_tokens"])
        if with_ids:
            assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"]


def test_repeated_rows_do_not_meet_in_one_group(spark):
    rows = [(7, "the same text", "en", "s", 13)] * 1000 + [(k, f"text {k}", "en", "s", 9) for k in range(100, 2100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    pieces = packing.cut_documents(docs, definition("byte_bpe_50k.json"), with_ids=False)
    packed = packing.pack(pieces, groups=10).collect()
    assert len(packed) == 3000 and sum(r["doc_id"] == 7 for r in packed) == 1000
    held = Counter(r["sequence_id"] >> packing.BINS_BITS for r in packed)
    assert len(held) == 10 and max(held.values()) < 450


def test_packing_repeated_rows_and_missing_ids(spark):
    rows = [(2, "a b", "s"), (2, "a b", "s"), (None, None, "s"), (2**62, "x", "s")]
    pieces = packing.cut_documents(made(spark, rows), definition("byte_bpe_50k.json"), with_ids=False)
    got = packing.pack(pieces).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([2, 2, None, 2**62])
    assert sorted(r["offset"] for r in got) == [0, 3, 6, 8]
    assert packing.cuts(3000, 1024) == [(0, 1024), (1024, 1024), (2048, 512), (2560, 256), (2816, 184)]
    assert packing.cuts(512, 1024) == [(0, 512)] and packing.cuts(0, 1024) == []
    assert packing.pack(packing.cut_documents(made(spark, []), definition("byte_bpe_50k.json"))).collect() == []


def test_token_files(spark, work, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK_IDS", 500)
    rows = [*corpus(), (None, "no id", "s"), (None, None, "s"), (5000, "twice", "s"), (5000, "twice", "s"), (-3, "less", "s")]
    path = work.path("tokens")
    tokenfiles.write_tokens(made(spark, rows), path, definition("word_bpe_49k.json"), work)
    found = sorted(tokenfiles.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    at, order = 0, []
    for r in found:
        assert (r["start"], len(r["ids"])) == (at, 4 * r["n_tokens"]) and r["ids_crc32"] == zlib.crc32(r["ids"])
        at += r["n_tokens"]
        order.append(-(10**9) if r["doc_id"] is None else r["doc_id"])
    assert order == sorted(order)
    want = Counter((i, tuple(library_ids("word_bpe_49k.json", t, 1))) for i, t, _ in rows)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], dtype="<u4").tolist())) for r in found) == want
    counted = spark.read.parquet(f"{path}/vocabulary").collect()
    ids = Counter(n for (_, own), k in want.items() for n in own for _ in range(k))
    assert {r["id"]: r["n"] for r in counted} == ids


def test_token_files_of_nothing(spark, work):
    path = work.path("tokens")
    tokenfiles.write_tokens(made(spark, []), path, definition("word_bpe_49k.json"), work)
    assert tokenfiles.read_tokens(spark, path).collect() == []


def test_hashed_sample_is_the_head_of_the_hashes(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "if(id % 50 = 0, 'few', 'many') as name").repartition(7)
    counts = {"few": 400, "many": 19_600, "none": 0}
    hashed = rows.withColumn("hash", common.hash63(F.col("doc_id"))).collect()
    for n in (3, 500):
        got = common.hashed_sample(rows, "name", counts, n).collect()
        want = [r for name in ("few", "many") for r in sorted((r for r in hashed if r["name"] == name), key=lambda r: r["hash"])[:n]]
        assert {r["doc_id"] for r in got} == {r["doc_id"] for r in want} and len(got) == len(want)
    assert common.hashed_sample(rows, "name", {}, 5).count() == 0
