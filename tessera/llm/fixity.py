"""Operator 1: Merkle fixity audit of archived web records.

A page becomes a WARC resource record. Records lie in archive files in the order of page_id, FILE_PAGES ids a file, at byte offsets that are
running sums of the records' lengths (``layout``). A tree stands over the ordered offsets of each file: the lowest nodes cover
2^RANGE_BITS bytes of a file, a node of the next level FANOUT of those in order, up to one that covers the file, and then files in order up to one root.
A lowest node's digest is the SHA-256 of the offsets, lengths, copies and SHA-256s of the records that start in its range, in order of
offset; a higher one's that of its children's places and digests. So a record that is altered, lost, doubled, moved or swapped with its
neighbour changes the digests above it. An audit (``audit``) compares the roots of two replicas and descends into mismatching branches only,
down to records.

All is DataFrame work. A node has FANOUT children at most, or as many records as 2^RANGE_BITS bytes hold, so no list grows with the data.
Equal records under one page_id lie behind each other and are one row, a run of copies; running sums go in three levels (ids of a file, slices of an id
by digest, records of a slice), so an id with any number of rows is spread.

Defined results: a null url or html counts as empty; a null page_id lies in a file of its own, reported as null (as does the least long); two empty
replicas have equal roots; a replica against an empty one reports every record; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import saved, scratch

#: Bits of the lowest ranges of bytes, children of a node as bits, and ids in an archive file as bits.
RANGE_BITS, FANOUT_BITS, FILE_BITS = 16, 6, 12
#: The date that records bear: the table has none.
WARC_DATE = "2024-01-01T00:00:00Z"
#: The query's replica: of ids with these remainders modulo DAMAGED, records are altered, lost, stored again at the file's end, or swapped with the next id's.
DAMAGED, ALTERED, LOST, DOUBLED, SWAPPED = 97, 13, 41, 73, 29
#: What stands for a null id, and the file of records without one, lower than that of any id.
NO_ID, NO_FILE = -(2**63), -(2**52)


def record_id(page_id: Column, url: Column) -> Column:
    """A record's urn, from its id and url, so that replicas agree."""
    h = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("")), url))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a WARC resource record as text."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(html, F.lit(""))
    head = (("WARC-Type", F.lit("resource")), ("WARC-Record-ID", record_id(page_id, url)), ("WARC-Date", F.lit(WARC_DATE)), ("WARC-Target-URI", url), ("Content-Type", F.lit("text/html")), ("Content-Length", F.octet_length(body).cast("string")))
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in head]
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.0"), *lines), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def layout(pages: DataFrame) -> DataFrame:
    """(file, offset, length, copies, record_sha256, altered_sha256, page_id): one row for each run of equal records of a page.

    altered_sha256 is that of the record with its first byte damaged, for tests of an audit.
    """
    one = pages.select(F.col("page_id").cast("long").alias("page_id"), warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    damaged = F.sha2(F.concat(F.lit("w"), F.substring("record", 2, 2**31 - 1)), 256)
    one = one.select("page_id", F.sha2("record", 256).alias("record_sha256"), damaged.alias("altered_sha256"), F.octet_length("record").cast("long").alias("length"))
    runs = one.groupBy("page_id", "record_sha256").agg(F.first("altered_sha256").alias("altered_sha256"), F.first("length").alias("length"), F.count("*").alias("copies"))
    # ids as keys without nulls: the null id is lower than all others
    runs = saved(runs.withColumn("id", F.coalesce("page_id", F.lit(NO_ID))).withColumn("slice", F.substring("record_sha256", 1, 2)), "runs")
    size, zero = F.col("length") * F.col("copies"), F.lit(0).cast("long")
    before = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    file = F.when(F.col("id") == NO_ID, NO_FILE).otherwise(F.shiftright("id", FILE_BITS))
    slices = runs.groupBy("id", "slice").agg(F.sum(size).alias("bytes"))
    ids = slices.groupBy("id").agg(F.sum("bytes").alias("bytes")).withColumn("file", file)
    ids = ids.select("id", "file", F.coalesce(F.sum("bytes").over(before(W.partitionBy("file").orderBy("id"))), zero).alias("id_at"))
    slices = slices.select("id", "slice", F.coalesce(F.sum("bytes").over(before(W.partitionBy("id").orderBy("slice"))), zero).alias("slice_at"))
    runs = runs.withColumn("at", F.coalesce(F.sum(size).over(before(W.partitionBy("id", "slice").orderBy("record_sha256"))), zero))
    placed = runs.join(slices, ["id", "slice"]).join(ids, "id")
    return placed.select("file", (F.col("id_at") + F.col("slice_at") + F.col("at")).alias("offset"), "length", "copies", "record_sha256", "altered_sha256", "page_id")


def _joined(digest: Column) -> Column:
    """One digest of children (place, text) in order of place."""
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("place"), digest.alias("text")))), lambda c: F.concat_ws(":", c["place"].cast("string"), c["text"])), ","), 256)


def lowest(records: DataFrame) -> DataFrame:
    """(file, range, digest) of the ranges of bytes that records start in. Runs that start at one place are told apart by their digest."""
    own = F.concat_ws(":", F.col("length").cast("string"), F.col("copies").cast("string"), F.col("record_sha256"))
    return records.withColumn("place", F.col("offset")).groupBy("file", F.shiftright("offset", RANGE_BITS).alias("range")).agg(_joined(own).alias("digest"))


def parents(nodes: DataFrame, of_files: bool) -> DataFrame:
    """The level above: of ranges within a file, or, where every file is one range, of files."""
    place = "file" if of_files else "range"
    up = F.shiftright(place, FANOUT_BITS)
    keys = (up.alias("file"), F.lit(0).cast("long").alias("range")) if of_files else (F.col("file"), up.alias("range"))
    return nodes.withColumn("place", F.col(place)).groupBy(*keys).agg(_joined(F.col("digest")).alias("digest"))


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose digests differ or that only one side has."""
    both = a.withColumnRenamed("digest", "x").join(b.withColumnRenamed("digest", "y"), ["file", "range"], "full")
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select("file", "range")


def _below(nodes: DataFrame, wrong: DataFrame, of_files: bool) -> DataFrame:
    """The children of mismatching nodes."""
    if of_files:
        up = nodes.withColumn("up", F.shiftright("file", FANOUT_BITS))
        return up.join(wrong.select(F.col("file").alias("up")), "up", "left_semi").drop("up")
    up = nodes.withColumn("up", F.shiftright("range", FANOUT_BITS))
    return up.join(wrong.select("file", F.col("range").alias("up")), ["file", "up"], "left_semi").drop("up")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Places where two replicas (file, offset, length, copies, record_sha256, page_id) differ.

    file, offset, page_id, status, primary_sha256, replica_sha256, length, primary_copies, replica_copies: `missing` where the
    replica has no record, `extra` where the primary has none, `altered` where another one stands. Runs that start at one place are compared by digest.
    """
    with scratch(primary.sparkSession) as result:
        a, b = saved(primary, "primary"), saved(replica, "replica")
        reach = a.select("file", "offset").union(b.select("file", "offset")).agg(F.max("offset"), F.min("file"), F.max("file")).first()
        top, low, high = (reach[0] or 0) >> RANGE_BITS, reach[1] or 0, reach[2] or 0
        trees = [(saved(lowest(a), "ranges"), saved(lowest(b), "ranges"))]
        kinds: list[bool] = []
        # from one range a file on, files are combined, until those left are 0 and -1 (or one other, the root)
        while top > 0 or (low != high and not (low >= -1 and high <= 0)):
            kinds.append(top == 0)
            trees.append(tuple(saved(parents(side, kinds[-1]), "nodes") for side in trees[-1]))
            if top == 0:
                low, high = low >> FANOUT_BITS, high >> FANOUT_BITS
            top >>= FANOUT_BITS
        wrong = saved(_differing(*trees.pop()), "wrong")
        for level in reversed(kinds):
            if not wrong.take(1):
                break
            wrong = saved(_differing(*(_below(side, wrong, level) for side in trees.pop())), "wrong")
        inside = lambda side: side.withColumn("range", F.shiftright("offset", RANGE_BITS)).join(wrong, ["file", "range"], "left_semi")
        return result(_compared(inside(a), inside(b)), "audit")


def _compared(a: DataFrame, b: DataFrame) -> DataFrame:
    """Differences of two sets of records. Where one place has one run on either side they are compared as such, else by digest."""
    place = ["file", "offset"]
    a = a.select(*place, F.col("page_id").alias("pa"), F.col("record_sha256").alias("ra"), F.col("length").alias("la"), F.col("copies").alias("ca"))
    b = b.select(*place, F.col("page_id").alias("pb"), F.col("record_sha256").alias("rb"), F.col("length").alias("lb"), F.col("copies").alias("cb"))
    # equal runs go; of what is left, runs of one place meet in the order of their digests
    left = a.join(b.select(*place, F.col("rb").alias("ra"), F.col("lb").alias("la"), F.col("cb").alias("ca")), [*place, "ra", "la", "ca"], "left_anti")
    right = b.join(a.select(*place, F.col("ra").alias("rb"), F.col("la").alias("lb"), F.col("ca").alias("cb")), [*place, "rb", "lb", "cb"], "left_anti")
    left = left.withColumn("nth", F.row_number().over(W.partitionBy(*place).orderBy("ra", "ca")))
    right = right.withColumn("nth", F.row_number().over(W.partitionBy(*place).orderBy("rb", "cb")))
    both = left.join(right, [*place, "nth"], "full")
    status = F.when(F.col("ra").isNull(), "extra").when(F.col("rb").isNull(), "missing").otherwise("altered")
    zero = F.lit(0).cast("long")
    return both.select(F.nullif("file", F.lit(NO_FILE)).alias("file"), "offset", F.when(F.col("ra").isNull(), F.col("pb")).otherwise(F.col("pa")).alias("page_id"), status.alias("status"), F.col("ra").alias("primary_sha256"), F.col("rb").alias("replica_sha256"), F.coalesce("la", "lb").alias("length"), F.coalesce("ca", zero).alias("primary_copies"), F.coalesce("cb", zero).alias("replica_copies"))


def damaged(records: DataFrame) -> DataFrame:
    """A replica of a layout with known damage, for the query and its SQL; all other records stay where they are.

    By remainders of page_id: altered in place, lost (a hole stays), stored again behind the file's end, or swapped with the next id's record
    behind it.
    """
    left = F.coalesce(F.pmod("page_id", F.lit(DAMAGED)), F.lit(0))
    size = F.col("length") * F.col("copies")
    rows = records.withColumn("left", left).withColumn("record_sha256", F.when(left == ALTERED, F.col("altered_sha256")).otherwise(F.col("record_sha256")))
    ends = records.groupBy("file").agg(F.max(F.col("offset") + size).alias("end"))
    at = W.partitionBy("file").orderBy("offset").rowsBetween(W.unboundedPreceding, -1)
    again = rows.where(F.col("left") == DOUBLED).withColumn("shift", F.coalesce(F.sum(size).over(at), F.lit(0))).join(ends, "file")
    again = again.withColumn("offset", F.col("end") + F.col("shift")).drop("end", "shift")
    x = rows.where(F.col("left") == SWAPPED).select("file", F.col("offset").alias("x_at"), size.alias("x_size"), F.col("page_id").alias("x_id"))
    y = rows.where(F.col("left") == SWAPPED + 1).select(F.col("file").alias("y_file"), F.col("offset").alias("y_at"), size.alias("y_size"), F.col("page_id").alias("y_id"))
    pairs = x.join(y, (F.col("file") == F.col("y_file")) & (F.col("x_id") + 1 == F.col("y_id")) & (F.col("x_at") + F.col("x_size") == F.col("y_at")))
    moves = pairs.select("file", F.explode(F.array(F.struct(F.col("x_at").alias("offset"), (F.col("x_at") + F.col("y_size")).alias("to")), F.struct(F.col("y_at").alias("offset"), F.col("x_at").alias("to")))).alias("m")).select("file", "m.*")
    stay = rows.where(F.col("left") != LOST).join(moves, ["file", "offset"], "left").withColumn("offset", F.coalesce("to", "offset")).drop("to")
    return stay.unionByName(again).select(*records.columns)


def op1_merkle_audit(pages: DataFrame) -> DataFrame:
    with scratch(pages.sparkSession) as result:
        primary = saved(layout(pages), "layout")
        return result(audit(primary, damaged(primary)), "merkle-audit")


_CRLF = "chr(13) || chr(10)"
_HEAD = f" || {_CRLF} || ".join(("'WARC/1.0'", "'WARC-Type: resource'", "'WARC-Record-ID: <urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) || '>'", f"'WARC-Date: {WARC_DATE}'", "'WARC-Target-URI: ' || url", "'Content-Type: text/html'", "'Content-Length: ' || CAST(strlen(html) AS VARCHAR)"))
SQL = f"""
WITH base AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, md5(coalesce(CAST(page_id AS VARCHAR), '') || chr(10) || coalesce(url, '')) AS h FROM pages
), recs AS (
  SELECT page_id, {_HEAD} || {_CRLF} || {_CRLF} || html || {_CRLF} || {_CRLF} AS record FROM base
), runs AS (
  SELECT page_id, CAST(floor(page_id / {2**FILE_BITS}.0) AS BIGINT) AS file, coalesce(page_id % {DAMAGED}, 0) AS rest, sha256(record) AS sha, max(sha256('w' || substr(record, 2))) AS bad, CAST(max(strlen(record)) AS BIGINT) AS length, count(*) AS copies
  FROM recs GROUP BY page_id, sha256(record)
), placed AS (
  SELECT *, length * copies AS size, CAST(coalesce(sum(length * copies) OVER (PARTITION BY file ORDER BY page_id, sha ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos FROM runs
), swaps AS (
  SELECT x.file, x.pos AS x_at, y.pos AS y_at, y.size AS y_size FROM placed x JOIN placed y ON x.file = y.file AND x.page_id + 1 = y.page_id AND x.pos + x.size = y.pos WHERE x.rest = {SWAPPED} AND y.rest = {SWAPPED + 1}
), replica AS (
  SELECT p.file, coalesce(s.x_at + s.y_size, t.x_at, p.pos) AS pos, page_id, CASE WHEN rest = {ALTERED} THEN bad ELSE sha END AS sha, length, copies
  FROM placed p LEFT JOIN swaps s ON p.file = s.file AND p.pos = s.x_at LEFT JOIN swaps t ON p.file = t.file AND p.pos = t.y_at WHERE rest <> {LOST}
  UNION ALL
  SELECT file, fin + CAST(coalesce(sum(size) OVER (PARTITION BY file ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT), page_id, sha, length, copies
  FROM (SELECT *, max(pos + size) OVER (PARTITION BY file) AS fin FROM placed) WHERE rest = {DOUBLED}
)
SELECT coalesce(p.file, r.file) AS file, coalesce(p.pos, r.pos) AS "offset", coalesce(p.page_id, r.page_id) AS page_id, CASE WHEN p.sha IS NULL THEN 'extra' WHEN r.sha IS NULL THEN 'missing' ELSE 'altered' END AS status,
  p.sha AS primary_sha256, r.sha AS replica_sha256, coalesce(p.length, r.length) AS length, coalesce(p.copies, 0) AS primary_copies, coalesce(r.copies, 0) AS replica_copies
FROM placed p FULL JOIN replica r ON p.file IS NOT DISTINCT FROM r.file AND p.pos = r.pos
WHERE p.sha IS DISTINCT FROM r.sha OR p.copies IS DISTINCT FROM r.copies
"""
