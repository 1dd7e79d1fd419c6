"""What a publisher offers and what the archive holds: links to periods, manifests, contents, gaps."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How published labels spell months, and what archive members are.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DATA, IGNORED = (".csv", ".xlsx"), (".txt", ".md", ".pdf", ".docx", ".html")
PINS = ("sha256", "bytes", "content_format")


class ArchiveRefused(Exception):
    """An archive member that nothing classifies, or a pin that content has left behind."""


class _Links(HTMLParser):
    """Addresses and labels of the links of a page, however its attributes are written; entities are decoded."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[dict[str, str]] = []
        self.open: dict[str, str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "a":
            href = dict(attrs).get("href")
            self.open = {"href": href, "label": ""} if href else None
            self.found += [self.open] if self.open else []
        elif self.open:
            self.open["label"] += " "

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.open = None
        elif self.open:
            self.open["label"] += " "

    def handle_data(self, data: str) -> None:
        if self.open:
            self.open["label"] += data


def _links(pages: pd.Series) -> pd.Series:
    out = []
    for page in pages:
        reader = _Links()
        reader.feed(page or "")
        reader.close()
        out.append([{"href": x["href"].strip(), "label": " ".join(x["label"].split())} for x in reader.found])
    return pd.Series(out, dtype=object)


def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """href and plain label of every link of the pages' html, with the pages' other columns."""
    read = F.pandas_udf(_links, "array<struct<href:string,label:string>>")
    rows = pages.select(*[c for c in pages.columns if c != html], F.explode(read(html)).alias("_link"))
    return rows.select("*", "_link.href", "_link.label").drop("_link")


def label_period(label: Column) -> Column:
    """Month period (2024-05) of `May 2024`, year of `ALL of 2017`; null for what is no period."""
    text = F.lower(F.trim(F.regexp_replace(label, r"\s+", " ")))
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.regexp_extract(text, r"^([a-z]+) \d{4}$", 1))
    year = F.regexp_extract(text, r"(\d{4})$", 1)
    return F.when(text == "all of 2017", "2017").when(month > 0, F.concat_ws("-", year, F.lpad(month.cast("string"), 2, "0")))


def zip_year(href: Column) -> Column:
    """Year in the file name of a link to an annual archive; the path has the day of upload only."""
    base = F.regexp_extract(F.regexp_replace(href, r"[?#].*$", ""), r"([^/]*)$", 1)
    year = F.regexp_extract(base, r"(?i)(?:DonneesOuvertes?|Historique-BIXI-)[_-]?(20\d\d)", 1)
    return F.when(F.lower(href).endswith(".zip"), F.nullif(year, F.lit("")))


def name_span(name: Column) -> Column:
    """Year, or first and last year, in the name of a catalog's ridership resource; null for others."""
    years = F.regexp_extract_all(name, F.lit(r"(20\d\d)"), F.lit(1))
    wanted = F.contains(F.lower(name), F.lit("ridership")) & ~F.contains(F.lower(name), F.lit("readme"))
    return F.when(wanted & (F.size(years) == 1), F.element_at(years, 1)).when(wanted & (F.size(years) > 1), F.concat_ws("-", F.element_at(years, 1), F.element_at(years, -1)))


def catalog_resources(packages: DataFrame, payload: str = "payload") -> DataFrame:
    """name and url of every resource of catalog answers (JSON)."""
    schema = "struct<result:struct<resources:array<struct<name:string,url:string>>>>"
    told = F.from_json(payload, schema)
    return packages.select(F.explode(told["result"]["resources"]).alias("r")).select(F.coalesce("r.name", F.lit("")).alias("name"), F.coalesce("r.url", F.lit("")).alias("url"))


def by_period(links: DataFrame, period: Column) -> tuple[DataFrame, DataFrame]:
    """(system_id, period, url) of links (system_id, url), and those with no period or a second address for one.

    Of several addresses the least is kept, as rows have no order; the others are told.
    """
    rows = links.select("system_id", "url", period.alias("period"))
    first = rows.filter("period is not null").groupBy("system_id", "period").agg(F.min("url").alias("kept"))
    told = rows.join(first, ["system_id", "period"], "left")
    return first.withColumnRenamed("kept", "url"), told.filter("period is null or url <> kept").select("system_id", "period", "url")


def merge(manifest: DataFrame, found: DataFrame, accept_changes: bool = False) -> DataFrame:
    """The manifest (system_id, period, url, pins) with found periods (system_id, period, url), and a status for each.

    A new period has no pins. A changed address keeps the old one and its pins, as they are what was
    used, unless changes are accepted; then the pins go and the period is to be fetched again.
    """
    new = found.select("system_id", "period", F.col("url").alias("_found"))
    rows = manifest.withColumn("_known", F.lit(True)).join(new, ["system_id", "period"], "full")
    status = F.when(F.col("_known").isNull(), "new").when(F.col("_found").isNull(), "not offered").when(F.col("url") == F.col("_found"), "unchanged").otherwise("changed")
    moved = (F.col("status") == "changed") & F.lit(accept_changes)
    rows = rows.withColumn("status", status)
    return rows.select("system_id", "period", F.when((F.col("status") == "new") | moved, F.col("_found")).otherwise(F.col("url")).alias("url"), *[F.when(~moved, F.col(p)).alias(p) for p in PINS], "status")


def content_kind(content: Column) -> Column:
    """zip, html, csv or unknown, by the first bytes of a content; extensions lie."""
    head = F.substring(content, 1, 4096)
    text = F.regexp_replace(head.cast("string"), r"^\s+", "")
    low = F.lower(F.substring(text, 1, 512))
    page = low.startswith("<!doctype") | F.contains(low, F.lit("<html"))
    table = F.contains(text, F.lit(",")) & (F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r")))
    return F.when(F.hex(F.substring(content, 1, 4)) == "504B0304", "zip").when(page, "html").when(F.is_valid_utf8(head.cast("string")) & table, "csv").otherwise("unknown")


def inventory(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Status of every manifest entry (system_id, period, sha256, bytes) against files (system_id, period, content).

    pending: never fetched; missing; size; corrupt: another checksum; ok.
    """
    there = files.select("system_id", "period", F.length("content").cast("long").alias("_size"), F.sha2("content", 256).alias("_sha"))
    status = (F.when(F.col("sha256").isNull(), "pending").when(F.col("_size").isNull(), "missing").when(F.col("bytes") != F.col("_size"), "size")
              .when(F.col("sha256") != F.col("_sha"), "corrupt").otherwise("ok"))
    return manifest.join(there, ["system_id", "period"], "left").select("system_id", "period", status.alias("status"))


def month_gaps(periods: DataFrame) -> DataFrame:
    """Months between a system's first and last (system_id, period as yyyy-MM) that it does not have."""
    months = periods.filter(F.col("period").rlike(r"^\d{4}-\d{2}$")).select("system_id", "period").distinct()
    day = F.to_date(F.concat("period", F.lit("-01")))
    span = months.groupBy("system_id").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    want = span.select("system_id", F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("d")).select("system_id", F.date_format("d", "yyyy-MM").alias("period"))
    return want.join(months, ["system_id", "period"], "left_anti")


def pin(entry: dict, sha: str, size: int, accept_changes: bool = False) -> tuple[dict, str]:
    """A manifest entry after a fetch and what became of its pin; moved content is refused unless the entry is volatile or changes are accepted."""
    known = entry.get("sha256")
    if known and known != sha and not entry.get("volatile") and not accept_changes:
        raise ArchiveRefused(f"pinned {known[:12]}, fetched {sha[:12]}")
    status = "pinned" if not known else "verified" if known == sha else "moved" if entry.get("volatile") else "repinned"
    return entry | {"sha256": sha, "bytes": size}, status


def load_manifest(path: str | Path) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8")) if Path(path).exists() else {}


def save_manifest(path: str | Path, manifest: dict) -> None:
    """Written beside and moved into place, so that a broken run leaves the old one."""
    part = Path(f"{path}.part")
    part.write_text(json.dumps(manifest, indent=2, ensure_ascii=False) + "\n", encoding="utf-8")
    os.replace(part, path)


def _kind(where: str, member: str) -> str | None:
    """`data`, `archive` or nothing for a member to pass over; any other is refused."""
    base = member.rsplit("/", 1)[-1].lower()
    if not base or member.startswith("__MACOSX") or base.startswith((".", "~$")) or base.endswith(IGNORED):
        return None
    if base.endswith((".zip", *DATA)):
        return "archive" if base.endswith(".zip") else "data"
    raise ArchiveRefused(f"{where}: member {member} is neither data, an archive nor a document")


def _pieces(where: str, file, depth: int) -> Iterator[tuple[str, int, bytes]]:
    """(member, piece number, bytes) of every data member of a zip; nested archives are spooled, nothing is held whole."""
    if depth > 3:
        raise ArchiveRefused(f"{where}: nested more than three deep")
    with zipfile.ZipFile(file) as z:
        for info in z.infolist():
            base = info.filename.rsplit("/", 1)[-1]
            kind = _kind(where, info.filename)
            if kind == "archive":
                with tempfile.TemporaryFile() as spool, z.open(info) as inner:  # within this task, and gone with it
                    shutil.copyfileobj(inner, spool, PIECE)
                    yield from _pieces(f"{where} -> {base}", spool, depth + 1)
            elif kind == "data":
                with z.open(info) as inner:
                    yield base, 0, inner.read(PIECE)
                    n = 0
                    while piece := inner.read(PIECE):
                        n += 1
                        yield base, n, piece


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            path, sha = batch["path"][i].as_py(), batch["sha256"][i].as_py()
            for base, n, data in _pieces(path, pa.BufferReader(batch["content"][i].as_buffer()), 0):
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([sha]), pa.array([base]), pa.array([n], pa.int32()), pa.array([data], pa.binary())], ["archive", "sha256", "member", "piece", "content"])


MEMBERS = "archive string, sha256 string, member string, piece int, content binary"
#: Bytes of a member in one row.
PIECE = 8 << 20


def unpack(archives: DataFrame) -> DataFrame:
    """archive, sha256, member, piece and content of the data members of zip files (path, sha256, content), an archive a task, nested ones included.

    Members come in pieces of 8 MB, so their size is not bounded by what a row may hold. A member that
    nothing classifies stops the job; members of one archive with one name are refused by clashes().
    """
    return archives.select("path", "sha256", "content").mapInArrow(_unpacked, MEMBERS)


def clashes(members: DataFrame) -> DataFrame:
    """Members of an archive that would come to lie under one name."""
    return members.filter("piece = 0").groupBy("archive", "member").agg(F.count("*").alias("n")).filter("n > 1")


def unpack_into(store: str, archives: DataFrame) -> tuple[DataFrame, list[str]]:
    """Members (as unpack() gives them) of the archives (path, sha256, content), each archive unpacked once for each checksum.

    The store is a folder that all executors share; members lie there by their archive's checksum. What
    is there is not read again, so a second run unpacks nothing and a moved pin unpacks one archive.
    A checksum that is not its content's is refused before anything is kept. A run that breaks off
    leaves no folder that counts: a checksum is entered in the store's list after its members. Gives
    the members and the checksums that were unpacked now.
    """
    spark = archives.sparkSession
    wanted = archives.select("path", "sha256")
    new = wanted.select("sha256").distinct()
    if _there(spark, f"{store}/done"):
        new = new.join(spark.read.schema("sha256 string").parquet(f"{store}/done"), "sha256", "left_anti")
    fresh = [r[0] for r in new.collect()]  # a row for each archive
    if fresh:
        # One of equal archives; their content is read here only.
        mine = archives.filter(F.col("sha256").isin(fresh)).dropDuplicates(["sha256"])
        told = F.when(F.sha2("content", 256) == F.col("sha256"), F.col("content")).otherwise(F.raise_error(F.concat(F.col("path"), F.lit(" is not what its checksum says"))).cast("binary"))
        made = unpack(mine.withColumn("content", told))
        made.drop("archive").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("sha256").parquet(f"{store}/members")
        spark.createDataFrame([(s,) for s in fresh], "sha256 string").write.mode("append").parquet(f"{store}/done")
    if not _there(spark, f"{store}/members"):
        return spark.createDataFrame([], MEMBERS), fresh
    held = spark.read.schema("member string, piece int, content binary, sha256 string").parquet(f"{store}/members")
    return held.join(wanted.withColumnRenamed("path", "archive"), "sha256").select([c.split()[0] for c in MEMBERS.split(", ")]), fresh


def _there(spark, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
