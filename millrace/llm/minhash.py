"""Near-duplicates by b-bit MinHash.

1. Every text becomes the set of its five-word shingles (64-bit hashes). Texts
   with equal sets are one node, however many copies there are.
2. A node keeps ``BANDS * ROWS`` minima: bands of four full minima decide who is
   a candidate, and the low four bits of each minimum, sixteen to a long, are
   the signature. The share of equal fields, counted with bit counts and
   corrected for fields that agree by chance, estimates the similarity.
3. In each bucket of a band, all members are compared with one of them, the
   hub. Pairs whose estimate comes within ``SLACK`` of the threshold are
   confirmed on the full sets, and confirmed links are joined to components.
4. Members of one bucket that are still in different components are compared
   with each other, in blocks: first the signatures, which leave out members
   near no other component, then the full sets of the rest. A block gives the
   links that join components, fewer than it has members.

No step makes the pairs of a group: a group of copies costs rows by its size.

A pair at the threshold shares no band with a probability of (1 - s^4)^28, 5e-10
at a similarity of 0.85 and 4e-7 at 0.8, and is lost to the estimate with about
1e-5; pairs above it much more rarely.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keep, slices
from millrace.llm.components import connected_components
from millrace.session import Workspace

SHINGLE = 5
BANDS = 28
ROWS = 4
BITS = 4
MINIMA = BANDS * ROWS
LONGS = MINIMA * BITS // 64
SLACK = 0.17
# Members, and their shingles, in one of the two blocks that are compared, and
# pairs confirmed with one copy of the hub.
BLOCK = 512
BLOCK_SHINGLES = 1_000_000
CONFIRMED_TOGETHER = 256

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLIERS = (np.random.default_rng(20).integers(0, 2**31, MINIMA, dtype=np.uint32) * 2 + 1)[:, None]
_LOWEST_BITS = 0x1111111111111111

SKETCH = "n_shingles long, node binary, bands array<long>, signature array<long>"


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles.

    A-Z count as a-z, words are cut at ASCII white space. A text of fewer words
    than ``width`` has its whole sequence as the only shingle; no words, none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    n = len(words) - span + 1
    mixed = np.full(n, span, dtype=np.uint64)
    for k in range(span):
        mixed = (mixed * _MIX) ^ hashes[k : k + n]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the hash functions."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(low), 2048):
        np.minimum(least, (low[None, at : at + 2048] * _MULTIPLIERS).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A long for each band: equal for equal minima in the same band."""
    fields = least.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = (key * _MIX) ^ fields[:, k]
        key ^= key >> np.uint64(29)
    return (key * _MIX).view(np.int64)


def signature(least: np.ndarray) -> np.ndarray:
    """The low bits of all minima, packed into longs."""
    fields = (least & np.uint32(2**BITS - 1)).astype(np.uint64).reshape(LONGS, 64 // BITS)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(fields << shifts, axis=1).view(np.int64)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", by_row: bool = False) -> DataFrame:
    """One row per document; ``node`` names its set and is NULL for the empty set.

    ``row_no`` numbers the rows and ``text`` is kept beside the sketch, so that
    one row of a node can be taken for all. ``text_key``, a hash of the text, tells texts of one id and one set apart;
    it is there only if decisions are made ``by_row``.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                found = shingles(text)
                if len(found):
                    least = minima(found)
                    node = xxhash.xxh3_128_digest(found.tobytes())
                    rows.append((len(found), node, band_keys(least), signature(least)))
                else:
                    rows.append((0, None, None, None))
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.record_batch([*batch.columns, *made], names)

    given = "doc_id long, row_no long, text binary" + (", text_key string" if by_row else "")
    schema = f"{given}, {SKETCH}"
    names = [part.split()[0] for part in schema.split(", ")]
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.binary(), longs, longs]
    text = F.col(f"`{text_col}`")
    chosen = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row_no"),
        text.cast("binary").alias("text"),
        *[text_key(text).alias("text_key")] * by_row,
    )
    return chosen.mapInArrow(sketch, schema)


def text_key(text: Column) -> Column:
    """A hash that tells texts apart; NULL is no text."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit(""))


def _apart(x: Column, y: Column) -> Column:
    """How many of the fields of two longs differ."""
    d = x.bitwiseXOR(y)
    d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
    d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
    return F.bit_count(d.bitwiseAND(F.lit(_LOWEST_BITS)))


def estimate(x: Column, y: Column) -> Column:
    """Similarity of two signatures, corrected for fields equal by chance."""
    apart = sum((_apart(x[k], y[k]) for k in range(LONGS)), F.lit(0))
    chance = 2.0**-BITS
    return (1 - apart / F.lit(MINIMA) - chance) / (1 - chance)


def near_duplicates(
    docs: DataFrame,
    work: Workspace,
    *,
    percent: int = 85,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_row: bool = False,
) -> DataFrame:
    """Every row with its component of documents linked by similarity.

    Two documents are linked if ``100 * common >= percent * all`` shingles.
    Gives ``doc_id, n_shingles, component_id`` (the smallest id reachable) and
    ``kept`` (whether that is the row's own id). Texts without words, and NULL
    texts, are linked with nothing. A row without an id takes no part: its
    component is NULL and it is kept. Rows that share an id share the component
    of the smallest id their texts reach. An empty table gives no rows. Other
    columns of the input are not looked at, whatever their names.

    ``by_row`` adds ``text_key`` and decides for each id and text: ``kept`` are the
    rows of one id and text of each component, the smallest.
    """
    stored = keep(sketches(docs, id_col, text_col, by_row), work, "sketches")
    found = stored.drop("row_no", "text")
    linkable = found.where("doc_id IS NOT NULL AND node IS NOT NULL")
    nodes = keep(
        stored.where("doc_id IS NOT NULL AND node IS NOT NULL").groupBy("node").agg(
            F.min("row_no").alias("row_no"),
            *[F.min(F.struct("doc_id", "text_key")).alias("least_row")] * by_row,
            F.min("doc_id").alias("least_id"),
            F.min_by(F.struct("bands", "signature", "n_shingles"), "doc_id").alias("kept"),
        ),
        work,
        "nodes",
    )
    buckets, hubs = _buckets(nodes, work)
    labels = _link(stored, nodes, buckets, hubs, work, percent)
    least, of_component = ("least_row", "component_row") if by_row else ("least_id", "component_id")
    ids = nodes.select("node", least)
    reached = labels.join(ids, "node").groupBy("root").agg(F.min(least).alias(of_component))
    # Nodes without a link are components of their own.
    components = ids.join(labels.join(reached, "root").select("node", of_component), "node", "left").select(
        "node", F.coalesce(of_component, least).alias(of_component)
    )
    # Written, so that adaptive execution can cut the partition of a node with many copies.
    components = keep(components, work, "nodes_components")
    linked = linkable.drop("bands", "signature").join(components, "node").drop("node")
    alone = found.where("doc_id IS NULL OR node IS NULL").drop("node", "bands", "signature")
    if by_row:
        kept = F.struct("doc_id", "text_key").eqNullSafe(F.col(of_component))
        linked = linked.withColumn("kept", kept).withColumn("component_id", F.col(f"{of_component}.doc_id"))
        alone = alone.withColumn("kept", F.lit(True)).withColumn("component_id", F.col("doc_id"))
        columns = ["doc_id", "n_shingles", "component_id", "kept", "text_key"]
        return linked.select(columns).unionByName(alone.select(columns))
    both = linked.unionByName(alone.withColumn("component_id", F.col("doc_id")))
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _buckets(nodes: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Members of buckets with several nodes, and the pairs of a hub and a member."""
    banded = nodes.select(F.explode("kept.bands").alias("band"), "node", F.col("kept.n_shingles").alias("size"))
    shared = (
        banded.groupBy("band")
        .agg(F.min("node").alias("hub"), F.count("*").alias("n"), F.sum("size").alias("sizes"))
        .where("n > 1")
        .withColumn("blocks", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("sizes") / BLOCK_SHINGLES)).cast("int"))
    )
    buckets = keep(
        banded.join(shared, "band").select("band", "node", "hub", "n", "blocks"), work, "buckets"
    )
    pairs = buckets.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    return buckets, pairs


def _link(stored, nodes, buckets, hubs, work, percent) -> DataFrame:
    """Components over all links between nodes that share a bucket."""
    floor = percent / 100 - SLACK
    signatures = nodes.select("node", F.col("kept.signature").alias("signature"))
    left = signatures.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    right = signatures.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    near = hubs.join(left, "a").join(right, "b").where(estimate(F.col("sa"), F.col("sb")) >= floor)
    texts = keep(_texts(stored, nodes, buckets), work, "texts")
    links = keep(_confirm(near.select("a", "b"), texts, percent), work, "links")
    labels = connected_components(links, work, "components")
    open_members = keep(_across(buckets, labels, signatures, floor), work, "open_members")
    if not open_members.limit(1).count():
        return labels
    joining = keep(_join_within(open_members, texts, percent), work, "joining")
    return connected_components(links.unionAll(joining), work, "all_components")


def _texts(stored: DataFrame, nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """The text of one row of every node that may be compared, however many rows it has."""
    active = buckets.select("node").distinct().join(nodes.select("node", "row_no"), "node")
    return stored.select("row_no", "text").join(active, "row_no").select("node", "text")


PLACE = ["band", "i", "j"]


def _across(buckets: DataFrame, labels: DataFrame, signatures: DataFrame, floor: float) -> DataFrame:
    """Members of a bucket that may be linked to a member of another component.

    A bucket's members are dealt into blocks, and every pair of blocks (``i``,
    ``j``) is one group.
    """
    rooted = buckets.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The pairs with the hub are known, so two other members must differ.
    others = rooted.where("node <> hub")
    mixed = (
        others.groupBy("band")
        .agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
        .where("r1 <> r2")
        .select("band")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    spread = (
        others.join(mixed, "band")
        .join(signatures, "node")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "root", "signature")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, members in _groups(batches):
            yield _record_batch([(*place, *m[:2]) for m in _near_others(members, floor)], OPEN)

    dealt = spread.repartition(*PLACE).sortWithinPartitions(*PLACE)
    return dealt.mapInArrow(compare, OPEN)


OPEN = "band long, i int, j int, node binary, root binary"
LINKS = "a binary, b binary"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first three columns, and the other columns of each."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
    for place, group in groupby(rows, key=lambda row: row[:3]):
        yield place, [row[3:] for row in group]


def _record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*[part.split() for part in schema.split(", ")], strict=True)
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.record_batch([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def _root_numbers(roots: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(root, len(numbers)) for root in roots])


def _near_others(members: list[tuple], floor: float) -> list[tuple]:
    """Members (node, root, signature) whose estimate with another component's is high enough."""
    packed = np.array([m[2] for m in members], dtype=np.int64).view(np.uint64)
    roots = _root_numbers([m[1] for m in members])
    chosen = []
    for k, member in enumerate(members):
        d = packed[k] ^ packed
        d |= d >> np.uint64(1)
        d |= d >> np.uint64(2)
        apart = np.bitwise_count(d & np.uint64(_LOWEST_BITS)).sum(axis=1)
        similar = (1 - apart / MINIMA - 2.0**-BITS) / (1 - 2.0**-BITS)
        if np.any((similar >= floor) & (roots != roots[k])):
            chosen.append(member)
    return chosen


def _join_within(open_members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between components, confirmed on the full sets of a group's members."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, members in _groups(batches):
            yield _record_batch(_joining_links(members, percent), LINKS)

    rows = open_members.join(texts, "node").select(*PLACE, "node", "root", "text")
    dealt = rows.repartition(*PLACE).sortWithinPartitions(*PLACE)
    return dealt.mapInArrow(join, LINKS).distinct()


def _joining_links(members: list[tuple], percent: int) -> list[tuple[bytes, bytes]]:
    """Links that join the components of members (node, root, text), no more than needed."""
    sets = [(node, root, shingles(text)) for node, root, text in members]
    if len(sets) < 2:
        return []
    sizes = np.array([len(s[2]) for s in sets])
    common = _common(sets, sizes)
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    roots = _root_numbers([s[1] for s in sets])
    above = list(range(len(sets)))

    def top(k: int) -> int:
        while above[k] != k:
            above[k] = k = above[above[k]]
        return k

    found = []
    for x, y in np.argwhere(np.triu(linked & (roots[:, None] != roots[None, :]), 1)):
        rx, ry = top(roots[x]), top(roots[y])
        if rx != ry:
            above[rx] = ry
            found.append((sets[x][0], sets[y][0]))
    return found


def _common(sets: list[tuple], sizes: np.ndarray) -> np.ndarray:
    """How many shingles each two sets share."""
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, number, times = np.unique(np.concatenate([s[2] for s in sets]), return_inverse=True, return_counts=True)
    # A shingle of one set only is shared by no two.
    shared = times > 1
    place = np.cumsum(shared) - 1
    used = shared[number]
    owner, column = owner[used], place[number[used]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for first in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [first, first + 4096])
        has = np.zeros((len(sets), 4096), dtype=np.float32)
        has[owner[a:b], column[a:b] - first] = 1
        common += (has @ has.T).astype(np.int64)
    return common


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(CONFIRMED_TOGETHER)).cast("int").alias("parts"))
    dealt = pairs.join(counts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b")
    hubs = dealt.select("a", "part").distinct().join(texts.withColumnRenamed("node", "a"), "a")
    members = dealt.join(texts.withColumnRenamed("node", "b"), "b")
    rows = hubs.select("a", "part", F.lit(None).cast("binary").alias("b"), "text").unionByName(
        members.select("a", "part", "b", "text")
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub = None, None
        for batch in batches:
            linked = []
            for a, part, b, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                own = shingles(text)
                if b is None:
                    at, hub = (a, part), own
                elif (a, part) == at:
                    common = len(np.intersect1d(hub, own, assume_unique=True))
                    if 100 * common >= percent * (len(hub) + len(own) - common):
                        linked.append((a, b))
            columns = list(zip(*linked, strict=True)) or [[], []]
            yield pa.record_batch([pa.array(c, pa.binary()) for c in columns], ["a", "b"])

    placed = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return placed.mapInArrow(confirm, "a binary, b binary")
