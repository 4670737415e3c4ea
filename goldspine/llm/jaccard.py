"""N-gram Jaccard join of near-duplicate documents by grouped prefixes.

A document is its set of word shingles. Shingles are ordered rare ones first;
two sets similar enough share one of their first few, the prefix. Documents
with the same prefix and size are one group, groups that share a prefix shingle
are compared, and groups that pass the filters are expanded to their members,
whose shingles decide. What is joined grows with the documents, not with the
square of a cluster: members of a list already in one component are not compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from goldspine.llm.components import components
from goldspine.llm.exchange import PACKED, digit, pack, release_memory, unpack
from goldspine.llm.keys import FP, ID, NO_ID, TEXT, buckets, keyed, public_id, small_batches, text_bytes
from goldspine.llm.sketch import PARTIAL, half_powers, partial, slots, total
from goldspine.llm.tokens import SPACED, U64, chunks, grams, mix, pieces, words
from goldspine.sinks.staging import stage

SHINGLE = 5
#: Similarity in hundredths.
PERCENT = 80
#: Shingles are counted by so many bits of their hash.
COUNTER_BITS = 23
#: Bits of a bitmap for each shingle.
SPREAD = 4
#: How often one partner is drawn for each node before all pairs left are compared.
ROUNDS = 1
_PAIRS = "a long, b long"

_POSTING = np.dtype([("token", "u8"), ("group", "u8"), ("n", "i4"), ("at", "i4")])
_MEMBER = np.dtype([("group", "u8"), ("hi", "u8"), ("lo", "u8"), ("node", "i8"), ("n", "i4")])
_DOCUMENT = np.dtype([("id", "i8"), ("fp", "i8"), ("first", "i8"), ("n", "i4")])
#: A document in the graph: a hash of its id and its text, so that texts of one id are apart.
NODE = "_node"
#: What a bucket is sent, and what it lists.
POSTINGS, MEMBERS, DOCUMENTS, HUBS, COPIES = range(5)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, sorted; a text of fewer words has one for all of them."""
    (hashes,), begins = words(data, offsets, SPACED)
    all_grams = grams(hashes, SHINGLE)
    for first, last in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if last - first >= SHINGLE:
            yield np.unique(all_grams[first : last - SHINGLE + 1])
        elif last > first:
            yield grams(hashes[first:last], last - first)
        else:
            yield hashes[:0]


def _prefix_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1


def bitmap(sets: np.ndarray) -> bytes:
    """A bit for each shingle, of ``SPREAD`` times as many bits as there are shingles, to a power of two.

    Bits on one side only are shingles on one side only, so two bitmaps bound
    the overlap of their sets from above.
    """
    bits = max(6, int(SPREAD * len(sets) - 1).bit_length())
    marks = np.zeros(1 << bits, bool)
    marks[(sets >> U64(64 - bits)).astype(np.int64)] = True
    return np.packbits(marks).tobytes()


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often shingles come by, by the first bits of their hash."""
    counts = np.zeros(1 << COUNTER_BITS, np.int32)
    for _, data, offsets in chunks(batches, TEXT):
        for found in shingle_sets(data, offsets):
            counts[slots(found, COUNTER_BITS)] += 1  # a set may hold a counter twice: near enough
    yield partial(counts)


def _rarity(rows: DataFrame) -> np.ndarray:
    """The order of magnitude of each counter: 8 MiB for any corpus."""
    found = total(rows.select(TEXT).mapInArrow(_sketch, PARTIAL), half_powers)
    return found if len(found) else np.zeros(1 << COUNTER_BITS, np.uint8)


def _prefixes(rarity: Broadcast, n_groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = rarity.value
        for batch in pieces(batches, TEXT):
            postings, members, documents, posted = [], [], [], set()
            for part, data, offsets in chunks([batch], TEXT):
                keys = zip(*(part.column(c).to_pylist() for c in (ID, FP, NODE)))
                for (i, f, node), found in zip(keys, shingle_sets(data, offsets)):
                    n = len(found)
                    documents.append((i, f, node, n))
                    if not n:
                        members.append((0, 0, 0, node, 0))
                        continue
                    by_rarity = np.argsort(order[slots(found, COUNTER_BITS)], kind="stable")
                    prefix = found[by_rarity[: _prefix_length(n)]]
                    group = int(mix(np.array([int(mix(prefix).sum()) ^ n], U64))[0])
                    members.append((group, int(found.sum()), int(mix(found).sum()), node, n))
                    if group not in posted:
                        posted.add(group)
                        rows = np.empty(len(prefix), _POSTING)
                        rows["token"], rows["group"], rows["n"], rows["at"] = prefix, group, n, np.arange(len(prefix))
                        postings.append(rows)
            if not documents:
                continue
            # Equal sets of the batch go on as the one of the least node.
            ours, docs = np.array(members, _MEMBER), np.array(documents, _DOCUMENT)
            by_set = np.lexsort((ours["node"], ours["lo"], ours["hi"]))
            first = _first_of(ours["hi"][by_set], ours["lo"][by_set])
            docs["first"][by_set] = ours["node"][by_set[np.flatnonzero(first)[np.cumsum(first) - 1]]]
            docs["first"][docs["n"] == 0] = ours["node"][docs["n"] == 0]
            yield pack(docs, digit(mix(ours["node"].view(U64)), n_groups), DOCUMENTS)
            ours = ours[by_set[first]]
            ours = ours[ours["n"] > 0]
            if len(ours):
                yield pack(ours, digit(ours["group"], n_groups), MEMBERS)
                rows = np.concatenate(postings)
                yield pack(rows, digit(rows["token"], n_groups), POSTINGS)

    return run


_LISTED = "kind int, token long, `group` long, n int, `at` int, id long, fp long, hub long, hits long"
_LISTED_TYPES = pa.schema(
    [("kind", pa.int32()), ("token", pa.int64()), ("group", pa.int64()), ("n", pa.int32()), ("at", pa.int32())]
    + [(name, pa.int64()) for name in ("id", "fp", "hub", "hits")]
)


def _listed(kind: int, length: int, **columns: np.ndarray) -> pa.RecordBatch:
    columns["kind"] = np.full(length, kind, np.int32)
    arrays = []
    for field in _LISTED_TYPES:
        x = columns.get(field.name)
        if x is None:
            arrays.append(pa.nulls(length, field.type))
        else:
            x = np.ascontiguousarray(x)
            arrays.append(pa.array(x.view(np.int64) if x.dtype == U64 else x))
    return pa.RecordBatch.from_arrays(arrays, schema=_LISTED_TYPES)


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    out = np.zeros(len(keys[0]), bool)
    out[:1] = True
    for key in keys:
        out[1:] |= key[1:] != key[:-1]
    return out


def _lists(table: pa.Table) -> pa.Table:
    """What a bucket holds: documents, members of groups, copies of members, lists of several groups, hubs."""
    release_memory()
    out = []
    docs = unpack(table, _DOCUMENT, DOCUMENTS)
    if len(docs):
        out.append(_listed(DOCUMENTS, len(docs), id=docs["id"], fp=docs["fp"], n=docs["n"], hub=docs["first"]))
    members = unpack(table, _MEMBER, MEMBERS)
    if len(members):
        members = members[np.lexsort((members["node"], members["lo"], members["hi"], members["group"]))]
        first = _first_of(members["group"], members["hi"], members["lo"])
        leader = members["node"][np.flatnonzero(first)[np.cumsum(first) - 1]]
        ours = members[first]
        out.append(_listed(MEMBERS, len(ours), group=ours["group"], id=ours["node"], n=ours["n"]))
        out.append(_listed(COPIES, int((~first).sum()), id=members["node"][~first], hub=leader[~first]))
    rows = unpack(table, _POSTING, POSTINGS)
    if len(rows):
        # A shingle that one group has, once or from several tasks, joins nothing.
        rows = rows[np.argsort(rows["token"], kind="stable")]
        starts = np.flatnonzero(_first_of(rows["token"]))
        low, high = (f.reduceat(rows["group"], starts) for f in (np.minimum, np.maximum))
        rows = rows[np.repeat(low != high, np.diff(np.append(starts, len(rows))))]
    if len(rows):
        rows = rows[np.lexsort((rows["group"], rows["n"], rows["token"]))]
        rows = rows[_first_of(rows["token"], rows["group"])]
        out.append(_listed(POSTINGS, len(rows), token=rows["token"], group=rows["group"], n=rows["n"], at=rows["at"]))
        # A list's first group, the shortest, is the hub of those that are not too long for it.
        begins = _first_of(rows["token"])
        hub = rows[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
        near = ~begins & _passes(hub["n"], hub["at"], rows["n"], rows["at"])
        pairs, hits = np.unique(np.stack([rows["group"][near], hub["group"][near]]), axis=1, return_counts=True)
        out.append(_listed(HUBS, pairs.shape[1], group=pairs[0], hub=pairs[1], hits=hits.astype(np.int64)))
    return pa.Table.from_batches(out, _LISTED_TYPES)


def _passes(n1, at1, n2, at2) -> np.ndarray:
    """Whether the similarity is possible for these sizes and a shared shingle at these places of the order.

    What is shared before the shingle is before it in both, and what is shared after it is after it in both.
    """
    n1, at1, n2, at2 = (np.asarray(x, np.int64) for x in (n1, at1, n2, at2))
    sizes = 100 * np.minimum(n1, n2) >= PERCENT * np.maximum(n1, n2)
    return sizes & (np.minimum(at1, at2) + np.minimum(n1 - at1, n2 - at2) >= _overlap(n1, n2))


def _overlap(n1, n2):
    """The least overlap: 100 o >= P (n1 + n2 - o)."""
    return -(-PERCENT * (n1 + n2) // (100 + PERCENT))


def _pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = batch.column(TEXT).cast(pa.large_binary())
        packed = pa.array([squeeze.compress(x.as_buffer()) for x in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(NODE), packed], names=["node", "z"])


def _set_of(packed: bytes) -> np.ndarray:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return next(shingle_sets(data, np.array([0, len(data)])))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose shingles are similar enough."""
    held: dict[str, tuple[bytes, np.ndarray]] = {}

    def sets(side: str, packed: bytes) -> np.ndarray:
        if side not in held or held[side][0] != packed:
            held[side] = packed, _set_of(packed)
        return held[side][1]

    for batch in batches:
        keep = []
        for zx, zy in zip(batch.column("zx").to_pylist(), batch.column("zy").to_pylist()):
            x, y = sets("x", zx), sets("y", zy)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(common > 0 and 100 * common >= PERCENT * (len(x) + len(y) - common))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` that link. Texts of the first are met first, so those of a hub meet all of its pairs last."""
    first = pairs.join(texts.select(F.col("node").alias("a"), F.col("z").alias("zx")), "a")
    both = first.join(texts.select(F.col("node").alias("b"), F.col("z").alias("zy")), "b")
    return both.select("a", "b", "zx", "zy").mapInArrow(_verify, "a long, b long")


def _again(seed: int):
    """Of a bucket of lists: each node outside a list's largest component with one node of it, drawn by hash."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        token, node, comp, n, at = (table.column(c).to_numpy() for c in ("token", "node", "comp", "n", "at"))
        order = np.lexsort((node, comp, token))
        token, node, comp, n, at = (x[order] for x in (token, node, comp, n, at))
        runs = np.flatnonzero(_first_of(token, comp))
        lengths = np.diff(np.append(runs, len(token)))
        # Of each list, the run that is longest.
        by_length = np.lexsort((-lengths, token[runs]))
        largest = by_length[_first_of(token[runs][by_length])]
        lists = np.cumsum(_first_of(token)) - 1
        begin, length = runs[largest][lists], lengths[largest][lists]
        drawn = mix(token.view(U64) ^ mix(node.view(U64) + U64(seed))) % length.astype(U64)
        other = begin + drawn.astype(np.int64)
        fits = (comp != comp[other]) & _passes(n, at, n[other], at[other])
        found = np.unique(np.stack([node[fits], node[other][fits]]), axis=1)
        return pa.table({"a": found[0], "b": found[1]})

    return run


#: Pairs that are looked at at once.
_AT_ONCE = 1 << 20
#: Rows of lists that go together: more are dealt into slices, and each slice of
#: nodes outside the largest components meets each slice of the lists.
SLICE_ROWS = 1 << 14
_LISTED_HERE, _OUTSIDE = 1, 2


def _cross(table: pa.Table, bitmaps: pa.Table) -> pa.Table:
    """Of a bucket of slices: nodes outside with those of their list in other components, as sizes, places and bitmaps allow."""
    release_memory()
    table, bitmaps = table.combine_chunks(), bitmaps.combine_chunks()
    token, node, comp, n, at, role = (table.column(c).to_numpy() for c in ("token", "node", "comp", "n", "at", "role"))
    order = np.lexsort((n, token))
    token, node, comp, n, at, role = (x[order] for x in (token, node, comp, n, at, role))
    nodes, first, which = np.unique(node, return_index=True, return_inverse=True)
    held = dict(zip(bitmaps.column("node").to_pylist(), bitmaps.column("bits")))
    maps = [np.frombuffer(held[k].as_buffer(), np.uint64) for k in nodes.tolist()]
    sizes = n[first].astype(np.int64)
    found, held, waiting = [np.zeros(0, np.int64)], [], 0

    def sift() -> None:
        pairs = np.unique(np.concatenate(held)) if held else np.zeros(0, np.int64)
        found.append(pairs[_bitmaps_allow(maps, sizes, pairs // len(nodes), pairs % len(nodes))])

    listed, outside = (np.flatnonzero(role & kind) for kind in (_LISTED_HERE, _OUTSIDE))
    # A list is a run of a token, in order of size: what a node can meet there is a part of it.
    tokens, run = np.unique(token, return_inverse=True)
    place = run[listed] * (1 << 32) + n[listed]
    least = (PERCENT * n[outside].astype(np.int64) + 99) // 100
    most = np.minimum(100 * n[outside].astype(np.int64) // PERCENT, (1 << 32) - 1)
    begins = np.searchsorted(place, run[outside] * (1 << 32) + least, "left")
    counts = np.searchsorted(place, run[outside] * (1 << 32) + most, "right") - begins
    ends = np.cumsum(counts)
    for start in range(0, int(ends[-1]) if len(ends) else 0, _AT_ONCE):
        pair = np.arange(start, min(start + _AT_ONCE, int(ends[-1])))
        whose = np.searchsorted(ends, pair, "right")
        left = outside[whose]
        right = listed[begins[whose] + pair - (ends[whose] - counts[whose])]
        apart = (comp[left] != comp[right]) & _passes(n[left], at[left], n[right], at[right])
        one, other = which[left[apart]], which[right[apart]]
        held.append(np.unique(np.minimum(one, other) * len(nodes) + np.maximum(one, other)))
        waiting += len(held[-1])
        if waiting > _AT_ONCE:
            sift()
            held, waiting = [], 0
    sift()
    pairs = np.unique(np.concatenate(found))
    return pa.table({"a": nodes[pairs // max(1, len(nodes))], "b": nodes[pairs % max(1, len(nodes))]})


def _sliced(labelled: DataFrame, n_groups: int) -> DataFrame:
    """``bucket, token, node, comp, n, at, role``: lists of several components, where what is to meet meets.

    Of two nodes in different components one is outside the largest of the list,
    so nodes outside meet the list. Lists go by their least node: those of one
    cluster mostly share it, so a bitmap goes to few buckets. A node's slice is
    fixed by its hash, the same for all lists of a leader, and the number of
    slices by their rows; there are as many buckets as slices fill.
    """
    spark = labelled.sparkSession
    parts = labelled.groupBy("token", "comp").agg(F.count("node").alias("rows"), F.min("node").alias("leader"))
    several = (
        parts.groupBy("token").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("leader").alias("leader"),
            F.max_by("comp", F.struct("rows", "comp")).alias("largest"), F.sum("rows").alias("all"), F.max("rows").alias("most"),
        ).where("low <> high").select("token", "leader", "largest", "all", (F.col("all") - F.col("most")).alias("others"))
    )
    by_token = stage(several, "jaccard-open")
    slices = lambda rows: F.ceil(F.sum(rows) / SLICE_ROWS).cast("long")
    per_leader = stage(by_token.groupBy("leader").agg(
        slices("all").alias("lists"), slices("others").alias("outs"), F.sum("all").alias("all"), F.sum("others").alias("others"),
    ), "jaccard-slices")
    sent = per_leader.agg(F.sum(F.col("all") * F.col("outs") + F.col("others") * F.col("lists"))).first()[0] or 0
    n_buckets = max(n_groups, -(-int(sent) // SLICE_ROWS))
    open_lists = by_token.select("token", "leader", "largest").join(per_leader.select("leader", "lists", "outs"), "leader")
    rows = labelled.join(open_lists, "token")
    is_out = F.col("comp") != F.col("largest")
    zero = F.lit(0).cast("long")
    at_list, at_out = (F.pmod(F.xxhash64("node"), F.col(c)) for c in ("lists", "outs"))
    block = lambda i, j, role: F.struct(i.alias("i"), j.alias("j"), role.alias("role"))
    as_listed = F.transform(F.sequence(zero, F.col("outs") - 1), lambda i: block(i, at_list, F.lit(_LISTED_HERE)))
    as_out = F.transform(F.sequence(zero, F.col("lists") - 1), lambda j: block(at_out, j, F.lit(_OUTSIDE)))
    one = F.array(block(zero, zero, F.when(is_out, _LISTED_HERE | _OUTSIDE).otherwise(_LISTED_HERE)))
    blocks = F.when(F.col("lists") == 1, one).when(is_out, F.concat(as_listed, as_out)).otherwise(as_listed)
    return rows.select("leader", "token", "node", "comp", "n", "at", F.explode(blocks).alias("x")).select(
        F.pmod(F.xxhash64("leader", "x.i", "x.j"), F.lit(n_buckets)).alias("bucket"),
        # Slices of one list that fall into a bucket stay apart.
        F.xxhash64("token", "x.i", "x.j").alias("token"), "node", "comp", "n", "at", F.col("x.role").alias("role"),
    )


def _bitmaps_allow(maps: list[np.ndarray], sizes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs can be similar: bits on one side only are shingles on one side only, in both sets together."""
    allowed = np.zeros(len(left), bool)
    widths = np.array([len(m) for m in maps], np.int64)
    narrow = np.minimum(widths[left], widths[right])
    for width in np.unique(narrow).tolist():
        pairs = np.flatnonzero(narrow == width)
        used, where = np.unique(np.concatenate([left[pairs], right[pairs]]), return_inverse=True)
        matrix = np.stack([_folded(maps[k], width) for k in used.tolist()])
        one, other = where[: len(pairs)], where[len(pairs) :]
        for start in range(0, len(pairs), max(1, (1 << 19) // width)):
            part = slice(start, start + max(1, (1 << 19) // width))
            apart = np.bitwise_count(matrix[one[part]] ^ matrix[other[part]]).sum(1, dtype=np.int64)
            both = sizes[left[pairs[part]]] + sizes[right[pairs[part]]]
            allowed[pairs[part]] = both - apart >= 2 * (-(-PERCENT * both // (100 + PERCENT)))
    return allowed


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A bitmap of fewer words: places merge by their last bit, which keeps the first bits of the hash."""
    while len(bits) > words:
        flat = np.unpackbits(bits.view(np.uint8))
        bits = np.packbits(flat[0::2] | flat[1::2]).view(np.uint64)
    return bits


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = pa.array([bitmap(_set_of(z)) for z in batch.column("z").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("node"), maps], names=["node", "bits"])


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of lists with the component of their node."""
    return nodes.join(labels, "node", "left").select("token", "node", "n", "at", F.coalesce("component", "node").alias("comp"))


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components with further links."""
    stars = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(stars.unionByName(links))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id, _fp, n, component`` for each row of ``docs``: its set's size and a key of what links reach.

    Words are runs of anything but blanks, with A-Z lower-cased. Null and empty
    texts have empty sets, which link with nothing. Rows link by their texts
    alone: those that share an id, or have none, but not a text are apart. A
    node is a 64-bit hash of id and text, and a component's key its least node.
    Equal sets are the same class from the start and are never compared.

    Sets are 64-bit hashes of shingles. What is shuffled: a row of 24 bytes for
    each shingle of a prefix (a fifth of all), packed; compressed texts of those
    documents that share a prefix shingle with another group; pairs. First each
    group is compared with one hub, then each node with one drawn from the
    largest component of each of its lists; what is left are pairs of a list
    in different components, that sizes, places and bitmaps allow. Those are
    found in slices of a fixed number of rows, however long a list.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = keyed(docs, id_column, text_column).withColumn(NODE, F.xxhash64(ID, FP))
    n_groups = buckets(spark, text_bytes(rows))
    rarity = spark.sparkContext.broadcast(_rarity(rows))
    listed = stage(
        rows.mapInArrow(_prefixes(rarity, n_groups), PACKED).groupBy("bucket").applyInArrow(_lists, _LISTED), "jaccard-lists"
    )
    of = lambda kind: listed.where(F.col("kind") == kind)
    members = of(MEMBERS).select("group", F.col("id").alias("node"), "n")
    lists = of(POSTINGS).select("token", "group", "n", "at")
    heads = members.groupBy("group").agg(F.min("node").alias("head"), F.count("node").alias("size"))
    together = members.join(heads.where("size > 1"), "group")
    best = (
        of(HUBS).groupBy("group", "hub").agg(F.sum("hits").alias("hits"))
        .groupBy("group").agg(F.max_by("hub", F.struct("hits", "hub")).alias("hub"))
    )
    across = (
        best.join(heads.select("group", F.col("head").alias("a")), "group")
        .join(heads.select(F.col("group").alias("hub"), F.col("head").alias("b")), "hub").select("a", "b")
    )
    within = together.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    pairs = stage(across.unionByName(within).where("a <> b").distinct(), "jaccard-pairs")

    met = members.join(lists.select("group").distinct(), "group", "semi").select("node").unionByName(together.select("node")).distinct()
    texts = stage(
        rows.mapInArrow(_pack_texts, "node long, z binary").join(met, "node", "semi").dropDuplicates(["node"]),
        "jaccard-texts",
    )
    equal = of(COPIES).select(F.col("id").alias("a"), F.col("hub").alias("b"))
    links = stage(_verified(pairs, texts).unionByName(equal), "jaccard-links")
    labels = components(links)

    nodes = stage(
        lists.join(members.select("group", "node"), "group").select("token", "node", "n", "at").unionByName(
            together.select(F.col("group").alias("token"), "node", "n", F.lit(0).alias("at"))
        ), "jaccard-nodes"
    )
    # Rounds of one partner for each node that a list's largest component lacks, then
    # all pairs of lists whose nodes are still not all connected.
    for seed in range(ROUNDS):
        tried = _labelled(nodes, labels).withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(n_groups)))
        drawn = stage(tried.groupBy("bucket").applyInArrow(_again(seed), _PAIRS).distinct(), "jaccard-pairs")
        labels = _joined(labels, _verified(drawn, texts))
    labelled = stage(_labelled(nodes, labels), "jaccard-labelled")
    left = stage(_sliced(labelled, n_groups), "jaccard-left")
    maps = texts.mapInArrow(_bitmaps, "node long, bits binary")
    met = stage(left.select("bucket", "node").distinct().join(maps, "node"), "jaccard-bitmaps")
    rest = stage(left.groupBy("bucket").cogroup(met.groupBy("bucket")).applyInArrow(_cross, _PAIRS).distinct(), "jaccard-pairs")
    final = _joined(labels, _verified(rest, texts))

    every = of(DOCUMENTS).select(F.col("id").alias(ID), F.col("fp").alias(FP), F.col("n").cast("long").alias("n"), F.col("hub").alias("node"))
    return every.join(final, "node", "left").select(ID, FP, "n", F.coalesce("component", "node").alias("component"))


def summary(docs: DataFrame) -> DataFrame:
    """Each row with the least id of its component; a null id is the least."""
    found = stage(near_duplicates(docs), "jaccard-found")
    least = found.groupBy("component").agg(F.min(ID).alias("least"), F.count("*").alias("rows"))
    # Most rows are alone, and only the others look for their least id.
    several = least.where("rows > 1").select("component", "least")
    least_id = F.coalesce("least", ID)
    return found.join(several, "component", "left").select(
        public_id("doc_id"), F.col("n").alias("n_shingles"), F.when(least_id != NO_ID, least_id).alias("component_id")
    )
