"""WARC fixity: Merkle trees over records and their offset ranges, compared between replicas.

Records are framed as WARC responses and laid out in files by id; each has its offset range and a
SHA-256 over range and bytes. 256 neighbours make a node of the next level, up through the file
to one root. Two replicas are compared from the root down: with equal roots nothing below is read,
and else only the children of nodes that differ are compared. While these are in no more than
MOST_FILES files, the reading of the next level is limited to those files, which Parquet's statistics
turn into skipped pages, as records lie in order of their file.

`audit` compares records place by place, so a record that was lost or added makes all that follow it
in the file differ, although their bytes are whole. `reconciled` tells the two apart with a second
tree, over slots of ids and without offsets: a lost or added record touches its own slot's branch
only. The descent finds the slots that differ, and in these alone records are matched by id
and bytes: what is left over on both sides under one id is corrupt, on one side missing or extra.
Records that are whole but lie at another offset are moved.

Defined cases: null url or body are framed as empty; negative ids have files of their own; null ids
are dealt to the 4,096 files before file 0 by a hash of their url, ordered by their bytes; repeated
rows are records of their own; an empty archive has no root, and every record of the other replica
is then missing or extra; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketspark.llm.common import written

#: Children of a node as a power of two, and levels inside a file: a file's nodes of the last one are gathered in one.
FAN_BITS = 8
FILE_LEVELS = 2
#: Files that may be named in the filter of a level's reading.
MOST_FILES = 1000


def framed(url: Column, body: Column) -> Column:
    """The bytes of a WARC response record, as text."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def archived(pages: DataFrame, per_file: int = 1000, id_: str = "page_id", url: str = "url", body: str = "html", own: bool = False) -> DataFrame:
    """page_id, file, record, offset, length, digest: where each page's record lies and its fixity; with `own` that of its bytes alone too."""
    laid = pages.select(
        F.col(id_).cast("long").alias("page_id"),
        F.coalesce(F.floor(F.col(id_).cast("long") / per_file), -1 - F.pmod(F.xxhash64(url), F.lit(4096))).alias("file"),
        framed(F.col(url), F.col(body)).alias("bytes"),
    ).select("page_id", "file", F.octet_length("bytes").cast("long").alias("length"), F.sha2("bytes", 256).alias("own"))
    order = Window.partitionBy("file").orderBy("page_id", "own")
    placed = laid.select(
        "page_id", "file", (F.row_number().over(order) - 1).cast("long").alias("record"),
        F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
        "length", "own",
    )
    ranged = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), "own")
    return placed.select("page_id", "file", "record", "offset", "length", F.sha2(ranged, 256).alias("digest"), *(["own"] if own else []))


def _parent(level: int) -> list[Column]:
    """(file, record) of a node's parent, for a node of this level."""
    if level < FILE_LEVELS:
        return [F.col("file"), F.shiftright("record", FAN_BITS).alias("record")]
    if level == FILE_LEVELS:  # whatever a file still has is gathered in one node; files count from 0 above, negative ones between the others
        counted = F.when(F.col("file") < 0, -2 * F.col("file") - 1).otherwise(2 * F.col("file"))
        return [counted.alias("file"), F.lit(0).cast("long").alias("record")]
    return [F.shiftright("file", FAN_BITS).alias("file"), F.col("record")]


def tree(archive: DataFrame) -> list[DataFrame]:
    """The levels of the tree, records first: (file, record, digest) each; the last has one node at most.

    Files above the file level are counted from 0, so that 63 / FAN_BITS levels always end in one node.
    """
    levels = [archive.select("file", "record", "digest")]
    while True:
        k = len(levels) - 1
        at = levels[-1]
        up = at.select(*[c.alias(n) for c, n in zip(_parent(k), ("file", "record"), strict=True)], F.struct("file", "record", "digest").alias("child"))
        children = F.array_sort(F.collect_list("child"))
        joined = F.concat_ws(",", F.transform(children, lambda c: c["digest"]))
        levels.append(written(up.groupBy("file", "record").agg(F.sha2(joined, 256).alias("digest")).sortWithinPartitions("file", "record"), "tree"))
        if k >= FILE_LEVELS and len(levels[-1].take(2)) < 2:
            return levels


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """file, record, status of the nodes that the two do not share with equal digests: missing or extra in b, or corrupt."""
    other = b.select("file", "record", F.col("digest").alias("other"))
    both = a.join(other, ["file", "record"], "full")
    status = F.when(F.col("other").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("corrupt")
    return both.where(~F.col("digest").eqNullSafe(F.col("other"))).select("file", "record", status.alias("status"))


def _below(level: DataFrame, k: int, at: DataFrame, files: list[int] | None) -> DataFrame:
    """The nodes of level k whose parents are in at; read from these files alone where they are known."""
    if files is not None and k <= FILE_LEVELS:
        level = level.where(F.col("file").isin(files))
    parents = at.select(F.col("file").alias("f"), F.col("record").alias("r"))
    up = [c.alias(n) for c, n in zip(_parent(k), ("_f", "_r"), strict=True)]
    return level.select("*", *up).join(parents, (F.col("_f") == F.col("f")) & (F.col("_r") == F.col("r")), "left_semi").select("file", "record", "digest")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """file, record, status of every record that is not the same in both: corrupt, missing or extra in the replica.

    The nodes that differ are a written table at each level, so the plan of a level holds that level only.
    """
    one, two = tree(primary), tree(replica)
    while len(one) != len(two):  # one archive has more files: its tree is higher
        low = min(one, two, key=len)
        k = len(low) - 1
        up = low[-1].select(*[c.alias(n) for c, n in zip(_parent(k), ("file", "record"), strict=True)], "digest")
        low.append(up.select("file", "record", F.sha2(F.concat_ws(",", F.array("digest")), 256).alias("digest")))
    at = written(differing(one[-1], two[-1]), "differing")
    for k in range(len(one) - 2, -1, -1):
        named = at.select("file").distinct().take(MOST_FILES + 1)
        if not named:
            break
        files = None
        if k <= FILE_LEVELS and len(named) <= MOST_FILES:
            files = [r.file for r in named]
            if k == FILE_LEVELS:  # the parents' files are counted from 0: the numbers that children have
                files = [-(f + 1) // 2 if f % 2 else f // 2 for f in files]
        at = written(differing(*[_below(level[k], k, at, files) for level in (one, two)]), "differing")
    return at.select("file", "record", "status")


def audited(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Every record of the primary archive with its status in the replica: intact, corrupt or missing."""
    primary, replica = written(primary, "archive"), written(replica, "archive")
    found = audit(primary, replica).where("status <> 'extra'")
    return primary.join(found, ["file", "record"], "left").select(
        "page_id", "file", "record", "offset", "length", "digest", F.coalesce("status", F.lit("intact")).alias("status")
    )


def _slots(archive: DataFrame) -> DataFrame:
    """file, record (the slot of an id within its file), digest of the bytes of all its records in order."""
    held = archive.groupBy("file", "slot").agg(F.array_sort(F.collect_list(F.struct("page_id", "own"))).alias("rows"))
    joined = F.concat_ws(",", F.transform("rows", lambda r: F.concat_ws(":", F.coalesce(r["page_id"].cast("string"), F.lit("")), r["own"])))
    return held.select("file", F.col("slot").alias("record"), F.sha2(joined, 256).alias("digest"))


def reconciled(primary: DataFrame, replica: DataFrame, per_file: int = 1000) -> DataFrame:
    """page_id, file, record, offset, own, replica_own, replica_offset, status of every record of either archive, both made with `own`.

    status: intact, moved (whole, at another offset), corrupt (another content under the id), missing
    or extra. record and offset are the primary's, null for extra ones. Records of one id and
    content are matched in order of their offsets, and so are left-over records of one id.
    """
    # null ids have no slot of their own: their content's hash deals them
    slot = F.coalesce(F.pmod("page_id", F.lit(per_file)), F.pmod(F.xxhash64("own"), F.lit(per_file))).cast("long")
    sides = [written(a.withColumn("slot", slot), "archive") for a in (primary, replica)]
    found = audit(*[written(_slots(a).sortWithinPartitions("file", "record"), "slots") for a in sides])
    slots = written(found.select("file", F.col("record").alias("slot")), "differing")
    key = [F.col("file"), F.col("slot"), F.coalesce("page_id", F.lit(-(1 << 63))).alias("key")]
    one, two = (
        side.select(*key, "page_id", "own", F.col("offset").alias(f"{name}_offset"), "record")
        .withColumn("nth", F.row_number().over(Window.partitionBy("file", "slot", "key", "own").orderBy(f"{name}_offset")))
        for name, side in zip(("primary", "replica"), sides, strict=True)
    )
    whole = one.join(two.drop("page_id", "record"), ["file", "slot", "key", "own", "nth"])
    status = F.when(F.col("primary_offset") == F.col("replica_offset"), "intact").otherwise("moved")
    shown = ("page_id", "file", "record", "offset", "own", "replica_own", "replica_offset", "status")
    kept = whole.select("page_id", "file", "record", F.col("primary_offset").alias("offset"), "own", F.col("own").alias("replica_own"), "replica_offset", status.alias("status"))
    # only slots that differ have records without a counterpart
    at = ["file", "slot"]
    left = [
        a.join(slots, at, "left_semi").join(b.join(slots, at, "left_semi").select("file", "slot", "key", "own", "nth"), ["file", "slot", "key", "own", "nth"], "left_anti")
        .withColumn("nth", F.row_number().over(Window.partitionBy("file", "slot", "key").orderBy(f"{name}_offset")))
        for name, a, b in (("primary", one, two), ("replica", two, one))
    ]
    other = left[1].select("file", "slot", "key", "nth", F.col("own").alias("replica_own"), "replica_offset", F.col("page_id").alias("other_id"))
    both = left[0].join(other, ["file", "slot", "key", "nth"], "full")
    lost = F.when(F.col("own").isNull(), "extra").when(F.col("replica_own").isNull(), "missing").otherwise("corrupt")
    gone = both.select(F.coalesce("page_id", "other_id").alias("page_id"), "file", "record", F.col("primary_offset").alias("offset"), "own", "replica_own", "replica_offset", lost.alias("status"))
    return kept.unionByName(gone).select(*shown)
