"""Writers: points, tables in Markdown, split text, bundles, manifests, workbooks and a spool."""

from __future__ import annotations

import itertools
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions.text import formula_guard, md_cell


def geojson(points: DataFrame, properties: list[str]) -> DataFrame:
    """value: a feature a row, longitude first; `geojson_document` puts them together."""
    geometry = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return points.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), F.struct(*properties).alias("properties"))).alias("value"))


def geojson_document(features: DataFrame) -> Iterator[str]:
    yield '{"type":"FeatureCollection","features":['
    for k, row in enumerate(features.toLocalIterator()):
        yield ("," if k else "") + row[0]
    yield "]}"


def _xml(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def kml(points: DataFrame, name: str, note: str) -> DataFrame:
    """value: a placemark a row, its text escaped."""
    text = lambda c: _xml(F.coalesce(F.col(c).cast("string"), F.lit("")))
    place = F.concat(F.lit("<Point><coordinates>"), F.col("lon").cast("string"), F.lit(","), F.col("lat").cast("string"), F.lit("</coordinates></Point>"))
    return points.select(F.concat(F.lit("<Placemark><name>"), text(name), F.lit("</name><description>"), text(note), F.lit("</description>"), place, F.lit("</Placemark>")).alias("value"))


def markdown_rows(df: DataFrame) -> DataFrame:
    """value: a table row a row."""
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[md_cell(F.col(c).cast("string")) for c in df.columns]), F.lit(" |")).alias("value"))


def markdown_parts(df: DataFrame, words: int) -> Iterator[str]:
    """Tables of at most `words` words each, every one with the header; no row is split. Rows reach the driver a partition at a time."""
    head = "| " + " | ".join(df.columns) + " |\n|" + " --- |" * len(df.columns)
    held, n = [], 0
    for (row,) in markdown_rows(df).toLocalIterator():
        k = len(row.split())
        if held and n + k > words:
            yield "\n".join([head, *held])
            held, n = [], 0
        held.append(row)
        n += k
    if held:
        yield "\n".join([head, *held])


def split_text(text: str, limit: int) -> list[str]:
    """Text of several lines in parts of at most `limit` bytes, each behind the first line; a longer line stays whole."""
    head, *lines = text.splitlines(keepends=True) or [""]
    out, held, size = [], [], len(head.encode())
    for line in lines:
        n = len(line.encode())
        if held and size + n > limit:
            out.append(head + "".join(held))
            held, size = [], len(head.encode())
        held.append(line)
        size += n
    return [*out, head + "".join(held)] if held or not out else out


def guarded(df: DataFrame) -> DataFrame:
    """df whose text no spreadsheet will run."""
    return df.select(*[formula_guard(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def csv_bundle(df: DataFrame, key: str, path: str) -> None:
    """A folder of CSV for each key."""
    guarded(df).repartition(key).write.partitionBy(key).mode("overwrite").option("header", True).csv(path)


def manifests(docs: DataFrame, key: str, order: str) -> DataFrame:
    """key, manifest: a JSON list of each key's documents, in order."""
    rest = [c for c in docs.columns if c != key]
    items = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*rest).alias("_d")))), lambda x: x["_d"])
    return docs.groupBy(key).agg(F.to_json(items).alias("manifest"))


def column_changes(have: list[str], want: list[str]) -> list[tuple[str, str]]:
    """What makes one list of columns the other: those gone are deleted, new ones inserted, none moved."""
    return [("delete", c) for c in have if c not in want] + [("insert", c) for c in want if c not in have]


def typed_by_first_value(df: DataFrame) -> dict[str, str]:
    """Each column's type from its first value that is not null, text where there is none."""
    first = df.agg(*[F.first(F.col(c), ignorenulls=True).alias(c) for c in df.columns]).first()
    kinds = {bool: "boolean", int: "bigint", float: "double"}
    return {c: kinds.get(type(first[c]), "string") for c in df.columns}


def export_tables(tables: dict[str, DataFrame], path: str) -> None:
    """A Parquet folder for each table, decimals as doubles."""
    for name, df in tables.items():
        plain = df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])
        plain.write.mode("overwrite").parquet(f"{path}/{name}.parquet")


def file_actions(files: DataFrame, limit: int) -> DataFrame:
    """files (path, format, bytes, sha256) with what becomes of each: dropped with a reason, split, converted or copied; the first of equal content stays."""
    copy = F.row_number().over(Window.partitionBy("sha256").orderBy("path")) > 1
    kind = F.col("format")
    action = F.when(kind.isin("unknown", "image"), "drop").when(F.col("_copy"), "drop").when(kind.isin("text", "csv") & (F.col("bytes") > limit), "split").when(kind == "zip", "unpack").when(kind.isin("doc", "xls", "ppt", "msg", "rtf"), "convert").otherwise("copy")
    reason = F.when(kind.isin("unknown", "image"), "no text").when(F.col("_copy"), "same content")
    return files.withColumn("_copy", copy).withColumn("action", action).withColumn("reason", reason).drop("_copy")


def spool(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines, appended, while the store is away."""
    rows.write.mode("append").json(path)


def drained(spark, path: str, schema: str, stored: DataFrame, keys: list[str]) -> DataFrame:
    """The spooled rows that the store does not have; a line cut short costs that line alone."""
    from quernstone.operators.merge import orphans

    lines = spark.read.schema(schema + ", _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    good = lines.where(F.coalesce(F.col("_corrupt_record"), F.lit("")) == "").drop("_corrupt_record")
    return orphans(good.dropDuplicates(keys), stored, keys)


SHEET_ROWS = 1_048_575  # below a header, as spreadsheets have no more
#: Parts of a workbook that are the same in every one.
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_ODD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _letters(column: int) -> str:
    """A, B, ... Z, AA, ... of columns from 0."""
    out = ""
    while column >= 0:
        out, column = chr(65 + column % 26) + out, column // 26 - 1
    return out


def _cell(value, place: str) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{place}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float, Decimal)) and value == value and abs(value) != float("inf"):
        return f'<c r="{place}"><v>{value}</v></c>'
    text = _ODD.sub("", str(value))
    if text.startswith("=HYPERLINK("):
        return f'<c r="{place}" t="str"><f>{escape(text[1:])}</f></c>'
    return f'<c r="{place}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def write_workbook(tables: dict[str, DataFrame], path: str, dictionary: dict[str, str] | None = None, sheet_rows: int = SHEET_ROWS) -> list[str]:
    """A workbook with a sheet for each table and, with `dictionary`, one of what its columns mean; returns the sheets' names.

    Rows come to the driver a partition at a time and go straight into the file, so none but the
    sheet at hand is held. A table of more rows than a sheet takes goes on in further ones; text
    that a spreadsheet would run is guarded, but for links made by `hyperlink`.
    """
    names: list[str] = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:

        def sheet(name: str, header: list[str], rows: Iterator):
            """One sheet; the first row that it has no more room for, if there is one."""
            names.append(name)
            with book.open(f"xl/worksheets/sheet{len(names)}.xml", "w") as out:
                line = lambda cells, n: f"<row r=\"{n}\">{''.join(_cell(v, f'{_letters(k)}{n}') for k, v in enumerate(cells))}</row>".encode()
                out.write(f'{_XML}<worksheet xmlns="{_MAIN}"><sheetData>'.encode() + line(header, 1))
                left = None
                for n, row in enumerate(rows):
                    if n == sheet_rows:
                        left = row
                        break
                    out.write(line(row, n + 2))
                out.write(b"</sheetData></worksheet>")
            return left

        for name, df in tables.items():
            rows = iter(_guarded_but_links(df).toLocalIterator(prefetchPartitions=True))
            left, part = sheet(name[:31], df.columns, rows), 1
            while left is not None:
                part += 1
                left = sheet(f"{name[:27]} {part}", df.columns, itertools.chain([left], rows))
        if dictionary:
            sheet("data dictionary", ["column", "meaning"], iter(dictionary.items()))
        each = range(1, len(names) + 1)
        listed = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in zip(each, names, strict=True))
        book.writestr("xl/workbook.xml", f'{_XML}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{listed}</sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'{_XML}<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(f'<Relationship Id="rId{k}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in each) + "</Relationships>")
        book.writestr("_rels/.rels", f'{_XML}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k in each)
        book.writestr("[Content_Types].xml", f'{_XML}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>{parts}</Types>')
    return names


def _guarded_but_links(df: DataFrame) -> DataFrame:
    text = lambda c: F.when(F.startswith(F.col(c), F.lit("=HYPERLINK(")), F.col(c)).otherwise(formula_guard(F.col(c)))
    return df.select(*[text(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def append_version(rows: DataFrame, path: str, at: Column | None = None) -> None:
    """Rows as a new version of what they tell: appended with the time they are told, never written over."""
    rows.withColumn("inserted_at", at if at is not None else F.current_timestamp()).write.mode("append").parquet(path)
