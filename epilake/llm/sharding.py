"""Shards of nearly equal bytes that never part copies of a text: minimax contiguous partition.

Rows with equal text are one atomic group. Groups stand in the order of the
SHA-256 of their text, so a shard is a range of digests. The smallest capacity
that lets the groups, taken in order, fill the given number of shards is found
by binary search; whether a capacity does is checked greedily, each shard taking
groups until the next would not fit. The shards are cut there.

A group above the mean shard would leave others empty, so such groups stand first
and get a shard each, and the rest is divided into as many shards as are left.

The search sees the order through sections (ranges of digests) with their sums,
and divides further only those that a cut may fall into, so the driver holds a
bounded number of sums however many groups there are. All of it is DataFrame
functions; only the cuts and the row counts of the shards leave the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epilake.llm.tables import anonymous, stored

#: Hex digits of the digest that name a section at first, and those added when one is divided.
FIRST, MORE = 3, 1
#: Comes after all digests.
_END = "g"
#: Rows that are numbered together.
SLOTS = 8192


@dataclass(frozen=True)
class Shards:
    """``count`` shards. The law is ``bytes``: the largest shard is as small as the order allows."""

    count: int = 16


@dataclass(frozen=True)
class _Section:
    """Groups whose digests begin with ``prefix``: their bytes, and whether they are one group."""

    prefix: str
    size: int
    whole: bool


def text_size(text: Column) -> Column:
    """UTF-8 bytes (NULL: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_digest(text: Column) -> Column:
    """What tells texts apart and orders them; NULL counts as an empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _needed(sections: list[_Section], capacity: int, most: int, hopeful: bool) -> int:
    """Shards that the greedy filling takes, at most ``most`` + 1.

    Where a section holds several groups, it is either taken for divisible at any
    byte (``hopeful``: never more shards than in truth) or for one that cannot be
    divided (never fewer).
    """
    shards, room = 1, capacity
    for section in sections:
        size = section.size
        if size <= room:
            room -= size
        elif section.whole or not hopeful:
            if size > capacity:
                return most + 1
            shards, room = shards + 1, capacity - size
        else:
            full, rest = divmod(size - room, capacity)
            shards += full + (rest > 0)
            room = capacity - rest if rest else 0
        if shards > most:
            return most + 1
    return shards


def _least(sections: list[_Section], count: int, low: int, high: int, hopeful: bool) -> int:
    """The smallest capacity from ``low`` to ``high`` for which ``count`` shards suffice."""
    while low < high:
        middle = (low + high) // 2
        if _needed(sections, middle, count, hopeful) <= count:
            high = middle
        else:
            low = middle + 1
    return low


def _reach(sections: list[_Section], count: int, capacity: int, hopeful: bool) -> list[int]:
    """For each cut, the section that it falls into or before, at this capacity."""
    cuts, room = [], capacity
    for k, section in enumerate(sections):
        size = section.size
        while size > room and len(cuts) < count - 1:
            cuts.append(k)
            if section.whole or not hopeful:
                room = capacity
                break
            size -= room
            room = capacity
        room = max(0, room - size)
    return cuts + [len(sections)] * (count - 1 - len(cuts))


def _divided(groups: DataFrame, prefixes: list[str], digits: int) -> list[_Section]:
    """The sections of the groups under some prefixes, or under all for none, with ``digits`` more digits."""
    by_length: dict[int, list[str]] = {}
    for prefix in prefixes:
        by_length.setdefault(len(prefix), []).append(prefix)
    found = []
    for length, chosen in by_length.items():
        rows = groups.where(F.substring("key", 1, length).isin(chosen)) if length else groups
        sums = rows.groupBy(F.substring("key", 1, length + digits).alias("prefix")).agg(
            F.sum("size").alias("size"), F.count("*").alias("n")
        )
        found += [_Section(r["prefix"], int(r["size"]), r["n"] == 1) for r in sums.collect()]
    return sorted(found, key=lambda s: s.prefix)


def _capacity(groups: DataFrame, count: int) -> tuple[int, list[str]]:
    """The smallest feasible capacity of ``groups(key, size)``, and the digest prefix that each shard but the first begins with."""
    digits = FIRST
    while 16**digits < 64 * count:
        digits += 1
    sections = _divided(groups, [""], digits)
    if not sections:
        return 0, [_END] * (count - 1)
    while True:
        total = sum(s.size for s in sections)
        floor = max([-(-total // count), *(s.size for s in sections if s.whole)])
        low = _least(sections, count, floor, total, hopeful=True)
        high = _least(sections, count, max(low, *(s.size for s in sections)), total, hopeful=False)
        # The cuts of every capacity from low to high lie between these, unless a section holds several.
        divide = [s for s in sections if not s.whole and 64 * s.size > low]
        if not divide:
            early = _reach(sections, count, low, hopeful=False)
            late = _reach(sections, count, high, hopeful=True)
            touched = {k for a, b in zip(early, late, strict=True) for k in range(max(0, a - 1), min(len(sections), b + 1))}
            divide = [sections[k] for k in sorted(touched) if not sections[k].whole]
        if not divide:
            return low, [sections[k].prefix if k < len(sections) else _END for k in _reach(sections, count, low, hopeful=False)]
        gone = {s.prefix for s in divide}
        sections = [s for s in sections if s.prefix not in gone] + _divided(groups, sorted(gone), MORE)
        sections.sort(key=lambda s: s.prefix)


@dataclass(frozen=True)
class Plan:
    """Digests with a shard of their own, and where each further shard but the first begins."""

    alone: list[str]
    cuts: list[str]
    capacity: int

    def shard(self, key: Column) -> Column:
        """The shard of a digest."""
        shard = F.lit(len(self.alone))
        for number, cut in enumerate(self.cuts, len(self.alone) + 1):
            shard = F.when(key >= cut, number).otherwise(shard)
        for number, digest in enumerate(self.alone):
            shard = F.when(key == digest, number).otherwise(shard)
        return shard.cast("int")


def plan_shards(groups: DataFrame, rule: Shards) -> Plan:
    """Where to cut ``groups(key, size)``: groups above the mean of what is left come first, largest first, one to a shard."""
    count, total = rule.count, groups.agg(F.sum("size")).first()[0] or 0
    alone, rest = [], int(total)
    for row in groups.orderBy(F.desc("size"), "key").limit(count).collect():
        if row["size"] * (count - len(alone)) <= rest:
            break
        alone.append(row["key"])
        rest -= row["size"]
    others = groups.where(~F.col("key").isin(alone)) if alone else groups
    capacity, cuts = _capacity(others, count - len(alone)) if rest else (0, [_END] * (count - len(alone) - 1))
    return Plan(alone, cuts, capacity)


def _slots(rows: DataFrame, id_column: str) -> DataFrame:
    """``rows`` with ``slot``: numbers without gaps from 0 in each ``shard``.

    Rows are dealt to bins by the hash of their id, numbered in each bin, and
    the bins' counts are summed up, so that no shard is ever in one task. A bin
    that one frequent id has filled is dealt on by the row's number.
    """
    n = rows.count()
    bins = max(1, -(-n // SLOTS))
    md5 = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
    rows = rows.withColumn("bin", F.conv(F.substring(md5, 1, 8), 16, 10).cast("long") % bins)
    filled = rows.groupBy("bin").agg(F.count("*").alias("n")).where(F.col("n") > 4 * SLOTS)
    filled = stored(filled.select("bin", F.ceil(F.col("n") / SLOTS).alias("parts")), "filled")
    if filled.isEmpty():
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    else:
        rows = stored(rows.withColumn("number", F.monotonically_increasing_id()), "numbered").join(filled, "bin", "left")
        part = F.pmod(F.xxhash64("number"), F.coalesce("parts", F.lit(1).cast("long")))
        rows = rows.withColumn("part", part).drop("number", "parts")
    order = Window.partitionBy("bin", "part", "shard").orderBy(id_column, "key")
    dealt = rows.repartition(F.col("bin"), F.col("part")).withColumn("place", F.row_number().over(order))
    counts = stored(rows.groupBy("shard", "bin", "part").agg(F.count("*").alias("n")), "counts")
    earlier = Window.partitionBy("shard").orderBy("bin", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    starts = stored(starts, "starts")
    slot = (F.col("before") + F.col("place") - 1).cast("long")
    return dealt.join(starts, ["bin", "part", "shard"]).withColumn("slot", slot).drop("bin", "part", "place", "before")


def shards(docs: DataFrame, rule: Shards | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs(doc_id, text)``.

    Rows with equal text share a shard, a group that outgrows the mean shard has
    one to itself, and shards stay empty only where there are fewer groups. NULL and empty texts are one group of size 1 a row.
    ``slot`` numbers the rows of a shard by the hash of their id; rows that
    repeat an id have slots of their own. ``grown_shard`` is NULL: by this law
    one more shard moves rows between all. Other columns are ignored, and no
    rows give no rows.
    """
    rule = rule or Shards()
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        text_digest(F.col("text")).alias("key"),
    )
    narrow = stored(narrow, "keys")
    plan = plan_shards(_groups(narrow), rule)
    rows = _slots(narrow.withColumn("shard", plan.shard(F.col("key"))), "doc_id")
    law = F.lit("bytes").alias("law")
    return rows.select("doc_id", "size", "text_crc32", law, "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _groups(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")


def write_shards(docs: DataFrame, folder: str, rule: Shards | None = None, max_records: int = 1_000_000) -> DataFrame:
    """Write all rows and columns of ``docs(doc_id, text, …)`` to ``folder/shard=N``; returns ``shard, rows, size``.

    Texts are read twice and moved once, to the tasks that write them; files hold at
    most ``max_records`` rows, each in the order of its digests. Columns that are
    named ``shard`` are left out with an error.
    """
    rule = rule or Shards()
    if "shard" in {c.lower() for c in docs.columns}:
        raise ValueError("'shard' is the name of the output's folders")
    text = F.col("text")
    keys = stored(docs.select(text_digest(text).alias("key"), text_size(text).alias("size")), "keys")
    plan = plan_shards(_groups(keys), rule)
    rows = keys.withColumn("shard", plan.shard(F.col("key")))
    inner = anonymous(docs, "text").withColumn("key", text_digest(text)).withColumn("shard", plan.shard(F.col("key")))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = inner.repartitionByRange(tasks, "shard", "key", F.xxhash64(*[c for c in inner.columns if c != "text"]))
    dealt = dealt.sortWithinPartitions("shard", "key").drop("key").toDF(*docs.columns, "shard")
    dealt.write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy("shard").parquet(folder)
    return rows.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("size"))
