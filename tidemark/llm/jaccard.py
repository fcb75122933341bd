"""Connected documents of like shingle sets, by a grouped prefix join.

Documents of equal sets are one. Every set is ordered by one rule, shingles that many documents have last, and two sets of the wanted
likeness share a shingle among the first few of each, their prefixes. Sets of equal prefix and size form a group; groups are posted under
the shingles of their prefix, and what meets there is filtered by size, by the places of the common shingle and by a parity
signature, all of which bound the overlap from above, before members are expanded and their whole sets compared.

Only components are wanted, so a cloud of near copies is not compared all with all: first each list of postings sends its members to
its most central one, whose links join most of a cloud; then only members of different components still meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.components import components
from tidemark.llm.shared import text_slices, written

#: Hashes that a task counts at a time; documents, about, that make a shingle a frequent one; frequent shingles that all tasks may know. They only set the order of shingles.
SEGMENT, FREQUENT, MOST_FREQUENT = 2_000_000, 32, 500_000
#: Rows of a slice of a long list; pairs looked at together.
LIST, PAIRS = 4096, 2_000_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all runs of ``size`` words, from theirs."""
    n = len(words) - size + 1
    out = words[:n].copy()
    for i in range(1, size):
        out *= _GOLD
        out += words[i : i + n]
    return _mixed(out * _GOLD + np.uint64(size))


def shingle_sets(texts: list[bytes], length: int) -> list[np.ndarray]:
    """Per text the distinct 64-bit hashes, ascending, of all runs of ``length`` words, of all words if they are fewer, none without words. Words
    are the runs of anything but ASCII white space, A-Z in lower case."""
    from xxhash import xxh64_intdigest

    words = [t.lower().split() for t in texts]
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    each = np.fromiter(map(xxh64_intdigest, chain.from_iterable(words)), dtype=np.uint64, count=int(sizes.sum()))
    runs = _runs(each, length) if len(each) >= length else each[:0]
    out = []
    for start, size in zip((np.cumsum(sizes) - sizes).tolist(), sizes.tolist(), strict=True):
        if size >= length:
            some = np.sort(runs[start : start + size - length + 1])
            new = np.empty(len(some), dtype=bool)
            new[0] = True
            np.not_equal(some[1:], some[:-1], out=new[1:])
            out.append(some[new])
        else:
            out.append(_runs(each[start : start + size], size) if size else each[:0])
    return out


def _sets(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[bytes | None]]]:
    """Bounded batches with the sets of their texts and the sets' 128-bit digests."""
    from xxhash import xxh3_128_digest

    for batch in text_slices(batches, "text"):
        sets = shingle_sets(batch.column("text").to_pylist(), length)
        yield batch, sets, [xxh3_128_digest(s) if len(s) else None for s in sets]


def least_overlap(n, m, percent: int):
    """What two sets of these sizes must share at least."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n + 1 - -(-percent * n // 100)


def frequent_shingles(texts: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that many texts have, ascending, and about how many. Tasks count all their texts, equal ones once, and pass on what they
    meet twice; of more than ``MOST_FREQUENT`` the most frequent stay. The order of shingles may be any; this one keeps lists short."""

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}

        def counted() -> pa.RecordBatch:
            found, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *held.values()]), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[c > 1].view(np.int64)), pa.array(c[c > 1])], ["h", "c"])

        size = 0
        for _, sets, digests in _sets(batches, length):
            for s, digest in zip(sets, digests, strict=True):
                if digest is not None and digest not in held:
                    held[digest] = s
                    size += len(s)
            if size > SEGMENT:
                yield counted()
                size = 0
        yield counted()

    sums = written(texts.mapInArrow(repeated, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT), "frequent")
    step = F.floor(F.log2("c")).cast("int")
    sizes = sorted(sums.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["step"])
    within = [r["step"] for r, total in zip(sizes, np.cumsum([r["n"] for r in sizes]), strict=True) if total <= MOST_FREQUENT]
    top = sums.where(step >= min(within, default=1 << 30)).toArrow()
    h, c = top["h"].to_numpy().view(np.uint64), top["c"].to_numpy()
    order = np.argsort(h)
    return h[order], c[order]


def signature(hashes: np.ndarray) -> bytes:
    """Per bin of hashes, whether an odd number falls in it, about half as many bins as hashes. Sets differ in at least as many
    elements as their signatures in bits."""
    bits = max(64, 1 << max(0, len(hashes) // 2 - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def signature_distance(a: bytes, b: bytes) -> int:
    """Bits in which signatures differ, the longer one folded to the bins of the shorter."""
    x, y, size = int.from_bytes(a, "little"), int.from_bytes(b, "little"), min(len(a), len(b)) * 8
    for bits, which in ((len(a) * 8, 0), (len(b) * 8, 1)):
        value = (x, y)[which]
        while bits > size:
            bits //= 2
            value = (value >> bits) ^ (value & ((1 << bits) - 1))
        x, y = (value, y) if which == 0 else (x, value)
    return (x ^ y).bit_count()


def _sketched(docs: DataFrame, length: int, percent: int) -> DataFrame:
    """Per row of ``docs``: row, doc_id, ``n`` (size of its set), and unless that is 0 ``digest`` of the set, ``common`` (how many frequent shingles
    it has), ``prefix``, ``key`` (digest of prefix and size) and ``signature``."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent_shingles(rows.select("text"), length))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        frequent, times = shared.value
        for batch, sets, digests in _sets(batches, length):
            common, prefixes, keys, signatures = [], [], [], []
            for s in sets:
                many = np.zeros(len(s), dtype=bool)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                    many = frequent[at] == s
                # the others by their hash, then the frequent ones by number and hash
                first, wanted = s[~many], prefix_length(len(s), percent) if len(s) else 0
                if len(first) < wanted:
                    first = np.concatenate([first, s[many][np.argsort(times[at[many]], kind="stable")]])
                first = first[:wanted]
                common.append(int(many.sum()))
                prefixes.append(first.view(np.int64))
                keys.append(xxh3_128_digest(first.tobytes() + len(s).to_bytes(8)) if len(s) else None)
                signatures.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(common, pa.int64()),
                    pa.array(prefixes, pa.list_(pa.int64())), pa.array(keys, pa.binary()), pa.array(signatures, pa.binary()),
                ],
                ["row", "doc_id", "n", "digest", "common", "prefix", "key", "signature"],
            )

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return written(numbered.mapInArrow(made, "row long, doc_id long, n long, digest binary, common long, prefix array<long>, key binary, signature binary"), "sets")


def _may_link(n: Column, pos: Column, m: Column, other: Column, percent: int) -> Column:
    """Sizes, and the places of the first common shingle, allow the wanted overlap."""
    need = F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))  # far below 2^53
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.least(n - pos, m - other) >= need)


def _size_class(n: Column, percent: int) -> Column:
    """Sets that may link lie in one class or in neighbours."""
    return F.floor(F.log(n.cast("double")) / F.lit(log(100 / percent) * (1 + 1e-9))).cast("int") if percent < 100 else n.cast("int")


def _added(rows: DataFrame, keys: list[str], totals: dict[str, Column], hot: bool) -> DataFrame:
    """``rows`` with ``totals`` over the rows of equal ``keys``: by a window, or where one key may have any share of the rows by an
    aggregation and a join, which can be split."""
    if hot:
        return rows.join(rows.groupBy(*keys).agg(*[value.alias(name) for name, value in totals.items()]), keys)
    return rows.withColumns({name: value.over(Window.partitionBy(*keys)) for name, value in totals.items()})


def _lists(sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Each group (``g``) under its prefix's shingles (``token``) and its size class (``cls``), and as a guest under the next class, as far as another one
    is there, too, that may have a like size. A list of ``k`` has its most central group, the one with the largest share of frequent
    shingles, as ``centre``, and is ``open`` if that one's pairs aren't all pairs of its members.

    Only frequent shingles can have very long lists; a prefix has its others first."""
    heads = sets.select("row", "n", "common", "prefix").join(groups.select(F.col("g").alias("row"), "alone"), "row")
    # size, share of frequent shingles and whether the group is one set, in one number
    share = F.floor(255 * F.col("common") / F.col("n")).cast("long")
    mark = F.shiftleft("n", 9).bitwiseOR(F.shiftleft(share, 1)).bitwiseOR(F.col("alone").cast("long"))
    light = F.least(F.col("n") - F.col("common"), F.size("prefix"))
    slim = heads.select(F.col("row").alias("g"), mark.alias("mark"), light.alias("light"), F.posexplode("prefix").alias("pos", "token"))
    posted = written(slim.select("token", "g", "mark", "pos", (F.col("pos") >= F.col("light")).alias("hot")), "postings")
    kept = None
    for hot in (False, True):
        rows = posted.where(F.col("hot") == hot).select("token", "g", "mark", "pos").withColumn("class", _size_class(F.shiftright("mark", 9), percent))
        rows = _added(rows, ["token"], {"k": F.count("*"), "least": F.min("class"), "most": F.max("class")}, hot).where("k > 2 OR k = 2 AND most - least <= 1")
        # a guest only where another class than its own is there
        classes = F.when(F.col("most") > F.col("least"), F.array("class", F.col("class") + 1)).otherwise(F.array("class"))
        rows = rows.select("token", "g", "mark", "pos", "class", F.explode(classes).alias("cls"))
        rows = rows.select("token", "cls", (F.col("class") == F.col("cls")).alias("own"), "g", "mark", "pos")
        here = F.struct(F.shiftright("mark", 1).bitwiseAND(255).alias("share"), (-F.col("g")).alias("order"), "g", F.shiftright("mark", 9).alias("n"), "pos")
        totals = {"k": F.count("*"), "centre": F.max(here), "alone": F.min(F.col("mark").bitwiseAND(1)), "owned": F.max("own")}
        rows = _added(rows, ["token", "cls"], totals, hot).where("k > 1 AND owned")
        opened = ((F.col("k") > 2) | (F.col("alone") == 0)).alias("open")
        rows = rows.select("token", "cls", "own", "g", F.shiftright("mark", 9).alias("n"), "pos", "k", F.struct("centre.g", "centre.n", "centre.pos").alias("centre"), opened)
        kept = rows if kept is None else kept.unionByName(rows)
    return written(kept, "lists")


def _central_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Each list's members with its centre."""
    others = lists.where(F.col("g") != F.col("centre.g"))
    fine = others.where(_may_link(F.col("n"), F.col("pos"), F.col("centre.n"), F.col("centre.pos"), percent))
    return fine.select(F.least("g", "centre.g").alias("a"), F.greatest("g", "centre.g").alias("b")).distinct()


_KEY = ["kind", "token", "cls", "one", "two"]


def _met(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs within each run of equal keys that size, place, components and signature allow. Rows come in the order of their keys."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        edges = _edges(table)
        yield _pairs_in(table.slice(0, edges[-1]), edges, percent)
        held = table.slice(edges[-1])
    if held is not None:
        yield _pairs_in(held, np.array([0, held.num_rows]), percent)


def _edges(table: pa.Table) -> np.ndarray:
    """Where each run of equal keys starts."""
    new = np.zeros(table.num_rows, dtype=bool)
    new[:1] = True
    for c in _KEY:
        values = table[c].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new) if table.num_rows else np.zeros(1, dtype=np.int64)


def _pairs_in(table: pa.Table, edges: np.ndarray, percent: int) -> pa.RecordBatch:
    own, member, n, pos, low, high, part = (table[c].to_numpy() for c in ("own", "member", "n", "pos", "low", "high", "part"))
    kind, apart = table["kind"].to_numpy(), table["one"].to_numpy() != table["two"].to_numpy()
    signatures = table["signature"].to_pylist()
    ends = np.repeat(np.append(edges[1:], table.num_rows)[: len(edges)], np.diff(np.append(edges, table.num_rows)))[: table.num_rows]
    later = ends - np.arange(table.num_rows) - 1
    sums = np.cumsum(later)
    found: set[tuple[int, int, int]] = set()
    begin = 0
    while begin < table.num_rows:
        done = sums[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(sums, done + PAIRS, side="right")))
        counts = later[begin:end]
        x = np.repeat(np.arange(begin, end), counts)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(counts) - counts, counts)
        fine = (own[x] | own[y]) & (~apart[x] | (part[x] != part[y])) & ~((low[x] == high[x]) & (low[y] == high[y]) & (low[x] == low[y])) & (member[x] != member[y])
        x, y = x[fine], y[fine]
        need = least_overlap(n[x], n[y], percent)
        fine = (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need)
        x, y, need = x[fine], y[fine], need[fine]
        for i, j, most in zip(x.tolist(), y.tolist(), (n[x] + n[y] - 2 * need).tolist(), strict=True):
            a, b = signatures[i], signatures[j]
            if a is None or b is None or signature_distance(a, b) <= most:
                found.add((int(kind[i]), int(min(member[i], member[j])), int(max(member[i], member[j]))))
        begin = end
    kinds, a, b = zip(*sorted(found), strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["kind", "a", "b"])


def _remaining_pairs(lists: DataFrame, reps: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of different components that may still link: pairs of groups, from the open lists, expanded to their members, and
    members of one group. ``reps`` has ``r``, ``g``, ``n`` and ``root``."""
    groups = reps.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"))
    posted = written(lists.where("open").drop("centre", "open").join(groups, "g"), "open")
    several = posted.groupBy("token", "cls").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l <> h").select("token", "cls")
    alone = signatures.select(F.col("row").alias("member"), "signature")
    columns = ["kind", "token", "cls", "k", "own", "member", "n", "pos", "low", "high"]
    between = posted.join(several, ["token", "cls"]).select(F.lit(0).alias("kind"), "token", "cls", "k", "own", F.col("g").alias("member"), "n", "pos", "low", "high", "members")
    between = between.join(alone, "member", "left").select(*columns, F.when(F.col("members") == 1, F.col("signature")).alias("signature"))
    mixed = groups.where("low <> high").select("g", F.col("members").alias("k"))
    inside = reps.join(mixed, "g").select(F.lit(1).alias("kind"), F.col("g").alias("token"), F.lit(0).alias("cls"), "k", F.lit(True).alias("own"), F.col("r").alias("member"), "n", F.lit(0).alias("pos"), F.col("root").alias("low"), F.col("root").alias("high"))
    inside = inside.join(alone, "member").select(*columns, "signature")
    # a long list meets in slices, each with each
    slices = F.ceil(F.col("k") / F.lit(LIST)).cast("int")
    rows = between.unionByName(inside).withColumn("part", F.pmod(F.xxhash64("member"), slices).cast("int"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), slices - 1)).alias("with"))
    rows = rows.withColumn("one", F.least("part", "with")).withColumn("two", F.greatest("part", "with")).drop("with", "k")
    found = rows.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(lambda batches: _met(batches, percent), "kind int, a long, b long")
    found = written(found.distinct(), "met")
    of, root = reps.select("r", "g", "root"), [F.col("ra"), F.col("rb")]
    left, right = of.toDF("x", "a", "ra"), of.toDF("y", "b", "rb")
    expanded = found.where("kind = 0").join(left, "a").join(right, "b").where(root[0] != root[1]).select(F.col("x").alias("a"), F.col("y").alias("b"))
    return expanded.unionByName(found.where("kind = 1").select("a", "b")).distinct()


def _links(pairs: DataFrame, sets: DataFrame, reps: DataFrame, docs: DataFrame, length: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) whose whole sets have the wanted likeness."""
    narrow = sets.select("row", "n", "signature")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            most = (n + m - 2 * least_overlap(n, m, percent)).tolist()
            near = [signature_distance(x, y) <= z for x, y, z in zip(batch.column("s").to_pylist(), batch.column("t").to_pylist(), most, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    signed = pairs.join(narrow.toDF("a", "n", "s"), "a").join(narrow.toDF("b", "m", "t"), "b")
    near = written(signed.mapInArrow(close, "a long, b long"), "near")

    involved = near.select(F.explode(F.array("a", "b")).alias("r")).distinct().join(reps.select("r", "first", "digest"), "r")
    involved = written(involved, "involved")
    ids = involved.select(F.col("first").alias("wanted_id")).distinct()
    texts = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found, digests in _sets(batches, length):
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())], ["digest", "hashes"])

    full = texts.mapInArrow(whole, "digest binary, hashes binary").join(involved.select("r", "digest"), "digest")
    full = written(full.dropDuplicates(["r"]).select("r", "hashes"), "whole")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                s, t = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                shared = int((s[np.minimum(np.searchsorted(s, t), len(s) - 1)] == t).sum())
                keep.append(100 * shared >= percent * (len(s) + len(t) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = near.join(full.toDF("a", "x"), "a").join(full.toDF("b", "y"), "b")
    return written(both.select("a", "b", "x", "y").mapInArrow(linked, "a long, b long"), "links")


def near_documents(docs: DataFrame, doc_id: str, text: str, *, shingle: int = 3, percent: int = 90) -> DataFrame:
    """Per row: doc_id, ``n_shingles`` (distinct runs of ``shingle`` words; fewer words are one run) and ``component_id``, the smallest doc_id that links
    lead to, itself included. Two rows link when their sets share at least ``percent`` hundredths of their union.

    Null, empty and blank texts have an empty set and link with nothing. Very long texts are read whole. Rows of equal sets link, repeated rows and
    rows of one id included, and give a row each; rows of one id may lie in different components. A null doc_id is never the smallest unless
    its component has no other. An empty table gives an empty result. Other columns are left out, whatever their names.

    Shingles are told apart by 64-bit and sets by 128-bit hashes. Lists of postings, however long, are counted and centred by
    aggregations and met in slices of bounded size; no two rows of one component are compared once it is known.
    """
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sets = _sketched(docs, shingle, percent)
    equal = sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("first"), F.min("row").alias("r"), F.max("n").alias("n"), F.min("key").alias("key"))
    equal = written(equal, "equal")
    groups = written(equal.groupBy("key").agg(F.min("r").alias("g"), (F.count("*") == 1).alias("alone")), "groups")
    reps = written(equal.join(groups, "key").select("r", "g", "first", "digest", "n"), "reps")

    lists = _lists(sets, groups, percent)
    first = _central_pairs(lists, percent).unionByName(reps.where("r <> g").select(F.col("g").alias("a"), F.col("r").alias("b")))
    known = _links(first, sets, reps, docs, shingle, percent)
    roots = components(known)
    rooted = written(reps.join(roots, reps["r"] == roots["node"], "left").select("r", "g", "n", F.coalesce("root", "r").alias("root")), "rooted")
    rest = _links(_remaining_pairs(lists, rooted, sets.select("row", "signature"), percent), sets, reps, docs, shingle, percent)

    top = components(known.unionByName(rest))
    placed = written(reps.join(top, reps["r"] == top["node"], "left").select("digest", "first", F.coalesce("root", "r").alias("top")), "placed")
    named = placed.join(placed.groupBy("top").agg(F.min("first").alias("component_id")), "top").select("digest", "component_id")
    out = sets.select("doc_id", "n", "digest").join(named, "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
