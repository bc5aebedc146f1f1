"""Set-similarity self join of documents on word shingles by a grouped prefix join.

Two documents link when the Jaccard similarity of their sets of distinct 5-word shingles is at least 0.8.
The join is exact. It runs in three steps, none of which emits the pairs of a bucket:

1. Candidates. Each set is sorted by shingle hash; a fixed share of it (``REGION``) is sent out, packed by hash
   range, to find shingles that at least two documents hold. A set that overlaps another by 80 % must see a
   known number of such shingles in its region, or it has no partner and is finished. The number of ranges follows
   from the size of all texts, and a shingle that many documents hold travels once a batch, so no range outgrows a task.
2. Prefixes. For candidates alone (one document per distinct set) shingles get their document frequency.
   Shingles held once come first in the global order and can not match; the rest are ordered from rare to
   frequent. What is left of the prefix (n - ceil(0.8 n) + 1 shingles) gives the postings. Documents with an
   identical prefix and size collapse into one group. Each group lives in one cell: that of its first posting
   shingle of many groups (or of the most groups, if all are rare) and of its size class. Two cells meet if a posting
   holds groups of both and their sizes are in reach; nothing is closed transitively, so a passage that chains unrelated
   documents together does not make them meet.
3. Verification. Cells are cut into blocks by hash; each pair of blocks of two cells that meet is one task's work of
   bounded size. There, group pairs are filtered by size and shared prefix shingle, then expanded, and their
   members verified on exact overlap counts in integers. A document lives in one block of one cell, so each pair is
   verified once. A task returns one row a linked document: its links and the smallest document that they reach there.

Defined cases: null, empty and blank texts have no words: size 0, linked with nothing, their own component.
With fewer than five words the whole word sequence is the one shingle. Of several rows of one ``doc_id`` one text
counts, that of the fewest shingles (of equal ones, that of the smallest digest), and they give one row; rows whose
``doc_id`` is null are left out. Very long texts are whole sets like others. Extra columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, keep

WIDTH = 5
#: Similarity in hundredths.
PERCENT = 80
#: Share of a set, in hundredths, that the candidate step sends out; it has to exceed 100 - PERCENT.
REGION = 35
#: Shingles that a task packs before it sends them out, and documents (their number has to fit 16 bits).
PACK_TOKENS, PACK_DOCS = 1_500_000, 60_000
#: Characters of all texts for each hash range of the candidate step, and ranges at least.
RANGE_CHARS, LEAST_RANGES = 32 << 20, 512
#: From that many groups on, a posting is a cell of its own choice.
HOT = 64
#: Documents of a verification block: an eighth of the cell within these bounds; and its shingles, on average. A document
#: goes out once for each block that its own one meets.
BLOCK_SHARE, BLOCK_LEAST, BLOCK_DOCS, BLOCK_TOKENS = 8, 128, 4096, 2_000_000
#: Words whose hash a worker remembers.
WORDS_KEPT = 200_000

_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]
_STEPS = np.array(_STEP)
_SHARED = 0xFFFF


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``text``; A-Z are lower-cased, words end at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(words) < WIDTH:
        return _mixed((h * _STEPS[: len(h)]).sum(keepdims=True) + np.uint64(len(words)))
    last = len(h) - WIDTH + 1
    total = h[:last] * _STEP[0]
    for j in range(1, WIDTH):
        total += h[j : last + j] * _STEP[j]
    return np.unique(_mixed(total))


def _overlap_needed(n):
    """ceil(0.8 n): what a partner has to share with a set of n."""
    return (n * PERCENT + 99) // 100


def _region(n: int) -> int:
    return max(n - _overlap_needed(n) + 1, (n * REGION + 99) // 100)


def _planes(x: np.ndarray) -> bytes:
    """The bytes of sorted numbers, all first bytes before all second ones: these compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplaned(x: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _turned(x: np.ndarray) -> np.ndarray:
    """Halves swapped: a region holds the smallest hashes, whose upper halves are alike; ranges go by the lower ones."""
    return (x << np.uint64(32)) | (x >> np.uint64(32))


_PACKED = pa.schema([("bucket", pa.int32()), ("hashes", pa.binary()), ("owners", pa.binary()), ("docs", pa.binary()), ("doc_id", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("n", pa.int64()), ("said", pa.int64()), ("held", pa.int64())])
_PACKED_DDL = "bucket int, hashes binary, owners binary, docs binary, doc_id long, d1 long, d2 long, n long, said long, held long"


def _digest(s: np.ndarray) -> list[int]:
    return np.frombuffer(blake2b(s.tobytes(), digest_size=16).digest(), np.int64).tolist()


def _pack(buckets: int):
    def flushed(rows: list) -> pa.RecordBatch:
        rows.sort(key=lambda r: r[0])  # ids that lie near each other pack well
        ids, sets = [r[0] for r in rows], [r[1] for r in rows]
        docs = np.array(ids, np.int64)
        cut = [s[: _region(len(s))] for s in sets]
        owner = np.repeat(np.arange(len(docs)), [len(s) for s in cut])
        allh = _turned(np.concatenate(cut)) if cut else np.empty(0, np.uint64)
        order = np.argsort(allh, kind="stable")
        allh, owner = allh[order], owner[order]
        first = np.flatnonzero(np.r_[True, allh[1:] != allh[:-1]]) if len(allh) else np.empty(0, np.int64)
        runs = np.diff(np.r_[first, len(allh)])
        held = np.bincount(owner[np.repeat(runs > 1, runs)], minlength=len(docs))
        heads, alone = allh[first], runs == 1
        which = (heads >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]]) if len(which) else np.empty(0, np.int64)
        hashes, owners, known = [], [], []
        for lo, hi in zip(starts, np.r_[starts[1:], len(heads)], strict=True):
            mine, own = owner[first[lo:hi]], np.full(hi - lo, _SHARED, np.uint16)
            used, own[alone[lo:hi]] = np.unique(mine[alone[lo:hi]], return_inverse=True)
            hashes.append(_planes(heads[lo:hi]))
            owners.append(_planes(own))
            known.append(_planes(np.diff(docs[used], prepend=0)))
        none, least = [None] * len(starts), [None] * len(docs)
        table = {
            "bucket": np.r_[which[starts].astype(np.int32), (docs % buckets).astype(np.int32)],
            "hashes": hashes + least,
            "owners": owners + least,
            "docs": known + least,
            "doc_id": none + ids,
            "d1": none + [r[2][0] for r in rows],
            "d2": none + [r[2][1] for r in rows],
            "n": none + [len(s) for s in sets],
            "said": none + [r[3] for r in rows],
            "held": none + held.tolist(),
        }
        return pa.RecordBatch.from_arrays([pa.array(table[f.name], f.type) for f in _PACKED], schema=_PACKED)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, rows, held = _WordHashes(), [], 0
        for batch in batches:
            for doc, said, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                s = shingle_set(text.as_py(), hashes)
                rows.append((doc, s, _digest(s), said))
                held += _region(len(s))
                if held >= PACK_TOKENS or len(rows) >= PACK_DOCS:
                    yield flushed(rows)
                    rows, held = [], 0
        if rows:
            yield flushed(rows)

    return pack


_HELD = pa.schema([(name, pa.int64()) for name in ("doc_id", "d1", "d2", "n", "said", "held")])
_HELD_DDL = "doc_id long, d1 long, d2 long, n long, said long, held long"


def _held(table: pa.Table) -> pa.Table:
    """For one hash range: how many of its shingles each document shares with another one."""
    out = table.filter(pc.is_valid(table["doc_id"])).select(_HELD.names).cast(_HELD)
    packed = table.filter(pc.is_valid(table["hashes"]))
    hashes, docs, single = [], [], []
    for h, o, d in zip(packed["hashes"], packed["owners"], packed["docs"], strict=True):
        own, known = _unplaned(o.as_py(), np.uint16), np.cumsum(_unplaned(d.as_py(), np.int64))
        alone = own != _SHARED
        mine = np.zeros(len(own), np.int64)
        mine[alone] = known[own[alone]]
        hashes.append(_unplaned(h.as_py(), np.uint64))
        docs.append(mine)
        single.append(alone)
    if not hashes:
        return out
    allh, docs, alone = np.concatenate(hashes), np.concatenate(docs), np.concatenate(single)
    order = np.argsort(allh, kind="stable")
    allh, docs, alone = allh[order], docs[order], alone[order]
    first = np.flatnonzero(np.r_[True, allh[1:] != allh[:-1]])
    runs = np.diff(np.r_[first, len(allh)])
    shared = np.repeat((runs > 1) | ~np.logical_and.reduceat(alone, first), runs)
    ids, counts = np.unique(docs[shared & alone], return_counts=True)
    none = pa.nulls(len(ids), pa.int64())
    return pa.concat_tables([out, pa.Table.from_arrays([pa.array(ids, pa.int64()), none, none, none, none, pa.array(counts, pa.int64())], schema=_HELD)])


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = _WordHashes()
    for batch in batches:
        sets = [shingle_set(t.as_py(), hashes).view(np.int64) for t in batch.column(2)]
        ends = np.cumsum([0] + [len(s) for s in sets])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets) if sets else [], pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "copies", "tokens"])


class _Lists:
    """Lists of numbers, one after the other in one array."""

    def __init__(self, lists: list[np.ndarray]):
        self.flat = np.concatenate(lists) if lists else np.empty(0, np.int64)
        self.sizes = np.array([len(x) for x in lists], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __getitem__(self, k: int) -> np.ndarray:
        return self.flat[self.starts[k] : self.starts[k] + self.sizes[k]]

    def marked(self, mark: np.ndarray, which: np.ndarray) -> np.ndarray:
        """How many members of each of the lists ``which`` are marked."""
        sizes = self.sizes[which]
        if 2 * sizes.sum() > len(self.flat):
            return np.add.reduceat(mark[self.flat], self.starts, dtype=np.int64)[which]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[which] - (ends - sizes), sizes)
        return np.add.reduceat(mark[self.flat[at]], ends - sizes, dtype=np.int64)


def _groups(n: np.ndarray, prefixes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, _Lists]:
    """Group of each document, and size and prefix of each group: identical size and prefix is one group."""
    number: dict = {}
    of = np.array([number.setdefault((size, p.tobytes()), len(number)) for size, p in zip(n.tolist(), prefixes, strict=True)], np.int64)
    _, first = np.unique(of, return_index=True)
    return of, n[first], _Lists([prefixes[k] for k in first])


def linked(side: np.ndarray, copies: np.ndarray, n: np.ndarray, prefix: np.ndarray, tokens: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links of the documents of a block with itself (side 2), or of one block (0) with another (1).

    -> each document's links, copies of its partners counted, and its component: the smallest position in it.
    """
    label, links = np.arange(len(n)), np.zeros(len(n), np.int64)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    if not len(left) or not len(right):
        return links, label
    same = side[0] == 2
    _, flat = np.unique(np.concatenate(tokens), return_inverse=True)
    ends = np.cumsum([len(t) for t in tokens])
    sets = np.split(flat.reshape(-1), ends[:-1])
    prefixes = [s[:p] for s, p in zip(sets, prefix, strict=True)]
    their_group, their_n, their_prefix = _groups(n[right], [prefixes[k] for k in right])
    my_group, my_n, my_prefix = (their_group, their_n, their_prefix) if same else _groups(n[left], [prefixes[k] for k in left])
    theirs, right_n = _Lists([sets[k] for k in right]), n[right]
    mark, every = np.zeros(int(flat.max()) + 1, np.uint8), np.arange(len(their_n))
    order = np.argsort(my_group, kind="stable")
    members = np.split(order, np.flatnonzero(np.diff(my_group[order])) + 1)
    for g in range(len(my_n)):
        met = every[g:] if same else every
        met = met[100 * np.minimum(their_n[met], my_n[g]) >= PERCENT * np.maximum(their_n[met], my_n[g])]
        if not len(met):
            continue
        mark[my_prefix[g]] = 1
        met = met[their_prefix.marked(mark, met) > 0]
        mark[my_prefix[g]] = 0
        if not len(met):
            continue
        chosen = np.zeros(len(their_n), bool)
        chosen[met] = True
        expanded = np.flatnonzero(chosen[their_group])
        for m in members[g]:
            few = expanded[(their_group[expanded] > g) | (expanded > m)] if same else expanded
            if not len(few):
                continue
            mine = sets[left[m]]
            mark[mine] = 1
            both = theirs.marked(mark, few)
            mark[mine] = 0
            good = right[few[100 * both >= PERCENT * (n[left[m]] + right_n[few] - both)]]
            if not len(good):
                continue
            links[left[m]] += copies[good].sum()
            links[good] += copies[left[m]]
            roots = np.unique(np.r_[label[left[m]], label[good]])
            if len(roots) > 1:
                joins = np.zeros(len(label), bool)
                joins[roots] = True
                label[joins[label]] = roots[0]
    return links, label


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (meet, more, side, doc_id, copies, n, prefix, tokens), sorted by meet and more: the pair of blocks."""

    def checked(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).sort_by("doc_id").combine_chunks()
        numbers = {c: rows[c].to_numpy() for c in ("side", "doc_id", "copies", "n", "prefix")}
        lists = rows["tokens"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        sets = [flat[lo:hi] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        links, label = linked(numbers["side"], numbers["copies"], numbers["n"], numbers["prefix"], sets)
        some = np.flatnonzero(links)
        docs = numbers["doc_id"]
        return pa.RecordBatch.from_arrays([pa.array(docs[some]), pa.array(docs[label[some]]), pa.array(links[some])], schema=_LINKS)

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        meet, more = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero(np.r_[True, (meet[1:] != meet[:-1]) | (more[1:] != more[:-1])])
        for lo, hi in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            if held and last != (meet[lo], more[lo]):
                yield checked(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = (meet[lo], more[lo])
    if held:
        yield checked(held)


def _in_cells(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents with their cell (``home, class``), and pairs of different cells that a posting holds both of."""
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT)) + 1e-9).cast("int")
    head = F.slice("tokens", 1, F.col("prefix"))
    sets = keep(sets.withColumn("g1", F.col("tokens")[0]).withColumn("g2", F.xxhash64(head)), "prefixes")
    groups = keep(sets.groupBy("n", "g1", "g2").agg(F.min("doc_id").alias("gid"), F.count("*").alias("members"), F.any_value(head).alias("head")), "groups")
    posts = groups.select("gid", F.posexplode("head").alias("at", "token"))
    often = keep(posts.groupBy("token").agg(F.count("*").alias("groups")).where("groups > 1"), "postings")
    held = keep(posts.join(often, "token").select("token", "gid", "at", "groups"), "held")
    homes = held.groupBy("gid").agg(F.max(F.struct(F.least("groups", F.lit(HOT)).alias("k"), (-F.col("at")).alias("at"), "token"))["token"].alias("home"))
    named = groups.join(homes, "gid", "left").where("home is not null or members > 1")
    named = keep(named.select("n", "g1", "g2", "gid", F.coalesce("home", "g1").alias("home"), level.alias("class")), "named")
    rows = keep(sets.join(named.drop("gid"), ["n", "g1", "g2"]).drop("g1", "g2"), "cells")
    at = held.join(named.select("gid", "home", "class"), "gid").select("token", "home", "class").distinct()
    low, high = (at.select("token", F.col("home").alias(f"{x}_home"), F.col("class").alias(f"{x}_class")) for x in ("low", "high"))
    near = low.join(high, "token").where("low_class + 1 = high_class or low_class = high_class and low_home < high_home")
    return rows, near.drop("token").distinct()


def _met(rows: DataFrame, near: DataFrame) -> DataFrame:
    """Sends each document to every pair of blocks that its own block takes part in."""
    docs = F.greatest(F.lit(BLOCK_LEAST), F.least(F.lit(BLOCK_DOCS), F.ceil(F.count("*") / BLOCK_SHARE)))
    cells = keep(rows.groupBy("home", "class").agg(F.count("*").alias("docs"), F.ceil(F.greatest(F.count("*") / docs, F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks")), "blocks")
    of = lambda x: cells.select(*(F.col(c).alias(f"{x}_{c}") for c in ("home", "class", "blocks")))
    pairs = keep(near.join(of("low"), ["low_home", "low_class"]).join(of("high"), ["high_home", "high_class"]), "pairs")
    key = [F.col(c) for c in ("low_home", "low_class", "high_home", "high_class")]
    end = lambda side, x, y: pairs.select(F.col(f"{x}_home").alias("home"), F.col(f"{x}_class").alias("class"), F.col(f"{x}_blocks").alias("blocks"), F.col(f"{y}_blocks").alias("others"), F.lit(side).alias("side"), F.struct(*key).alias("key"))
    own = cells.where("docs > 1").select("home", "class", "blocks", F.col("blocks").alias("others"), F.lit(2).alias("side"), F.struct(*(c.alias(n) for c, n in zip((F.col("home"), F.col("class")) * 2, ("low_home", "low_class", "high_home", "high_class"), strict=True))).alias("key"))
    ends = own.unionByName(end(0, "low", "high")).unionByName(end(1, "high", "low"))

    block, j = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"), F.col("j")
    sent = rows.join(ends, ["home", "class"]).withColumn("block", block).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    mine = F.col("block")
    low = F.when(F.col("side") == 0, mine).when(F.col("side") == 1, j).otherwise(F.least(mine, j))
    high = F.when(F.col("side") == 0, j).when(F.col("side") == 1, mine).otherwise(F.greatest(mine, j))
    side = F.when(F.col("side") < 2, F.col("side")).when(j == mine, 2).when(mine < j, 0).otherwise(1)
    return sent.select(F.xxhash64("key", low, high).alias("meet"), F.xxhash64(high, "key", low).alias("more"), side.cast("long").alias("side"), "doc_id", "copies", F.col("n").cast("long").alias("n"), F.col("prefix").cast("long").alias("prefix"), "tokens")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> ``doc_id, n_shingles, component_id, n_links`` for every document of ``docs``; see the module's text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    docs = docs.select("doc_id", F.xxhash64("text").alias("said"), "text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_RANGES, -(-chars // RANGE_CHARS))
    held = docs.mapInArrow(_pack(buckets), _PACKED_DDL).groupBy("bucket").applyInArrow(_held, _HELD_DDL)
    one = F.min(F.when(F.col("n").isNotNull(), F.struct("n", "d1", "d2", "said")))
    each = keep(held.groupBy("doc_id").agg(one.alias("one"), F.sum("held").alias("held")).select("doc_id", "one.*", "held"), "sizes")
    least = F.greatest(F.lit(1), F.ceil(F.ceil(F.col("n") * PERCENT / 100) * (REGION + PERCENT - 100) / 100))
    alike = each.where("n > 0").groupBy("d1", "d2").agg(F.min(F.struct("doc_id", "said")).alias("rep"), F.count("*").alias("copies"), F.max(F.col("held") >= least).alias("may"))
    alike = alike.select("d1", "d2", "rep.doc_id", "rep.said", "copies", "may")
    reps = alike.where("may").select("doc_id", "said", "copies")

    texts = reps.join(docs, ["doc_id", "said"]).dropDuplicates(["doc_id", "said"]).select("doc_id", "copies", "text")
    tokens = keep(texts.mapInArrow(_tokens, "doc_id long, copies long, tokens array<long>"), "tokens")
    rows = tokens.select("doc_id", F.explode("tokens").alias("token"))
    often = keep(rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "often")
    ordered = rows.join(often, "token").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("held"))
    sets = tokens.select("doc_id", "copies", F.size("tokens").alias("n")).join(ordered, "doc_id")
    short = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - (F.col("n") - F.size("held"))
    sets = sets.select("doc_id", "copies", "n", short.cast("int").alias("prefix"), F.col("held.token").alias("tokens")).where("prefix > 0")

    met = _met(*_in_cells(sets)).repartition("meet").sortWithinPartitions("meet", "more")
    links = keep(met.mapInArrow(_verify, "a long, b long, links long"), "links")
    joined = components(links.where("a <> b").select("a", "b"), "linked")
    counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))

    found = alike.select("d1", "d2", F.col("doc_id").alias("rep"), "copies")
    found = found.join(joined.withColumnRenamed("node", "rep"), "rep", "left").join(counts, "rep", "left")
    return each.join(found, ["d1", "d2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )
