"""DOCX packages: text with run formatting, read in Arrow batches from binary files."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARAGRAPH = "struct<text:string,styleId:string,isBold:boolean,isItalic:boolean,maxFontSize:double,boldTextRatio:double>"
SCHEMA = f"path string, headers array<{PARAGRAPH}>, body array<{PARAGRAPH}>, footers array<{PARAGRAPH}>, error string"
_NS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_OFF = {"0", "false", "off"}


def _look(properties: ET.Element | None) -> dict:
    """Bold, italic and size (points) that a properties element states; what it leaves open is absent."""
    out: dict = {}
    for child in properties if properties is not None else ():
        tag, value = child.tag.removeprefix(_NS), child.get(f"{_NS}val")
        if tag in ("b", "i"):
            out[tag] = (value or "true").lower() not in _OFF
        elif tag == "sz" and (value or "").isdigit():
            out[tag] = int(value) / 2
    return out


def _styles(xml: bytes) -> dict[str, dict]:
    return {s.get(f"{_NS}styleId"): _look(s.find(f"{_NS}rPr")) for s in ET.fromstring(xml).iter(f"{_NS}style") if s.get(f"{_NS}styleId")}


def _own(element: ET.Element, tag: str) -> Iterator[ET.Element]:
    """Descendants with a tag that do not belong to a paragraph inside this one."""
    for child in element:
        if child.tag == _NS + tag:
            yield child
        elif child.tag != f"{_NS}p":
            yield from _own(child, tag)


def _run_text(run: ET.Element) -> str:
    marks = {f"{_NS}tab": " ", f"{_NS}br": "\n"}
    return "".join((x.text or "") if x.tag == f"{_NS}t" else marks.get(x.tag, "") for x in run)


def _tidy(text: str) -> str:
    lines = [re.sub(r"[ \t]{2,}", " ", x) for x in text.replace("\u00a0", " ").split("\n")]
    inner = [x if len(lines) == 1 else x.rstrip(" \t") if i == 0 else x.lstrip(" \t") if i == len(lines) - 1 else x.strip(" \t") for i, x in enumerate(lines)]
    return "\n".join(inner).strip()


def _solid(text: str) -> int:
    return sum(not c.isspace() for c in text)


def paragraphs(xml: bytes, styles: dict[str, dict]) -> list[dict]:
    """Non-empty paragraphs with what their runs make of them: bold share, italics, largest size."""
    out = []
    for p in ET.fromstring(xml).iter(f"{_NS}p"):
        style = p.find(f"{_NS}pPr/{_NS}pStyle")
        name = style.get(f"{_NS}val") if style is not None else None
        runs = [(t, {**styles.get(name, {}), **_look(r.find(f"{_NS}rPr"))}) for r in _own(p, "r") if (t := _run_text(r))]
        text = _tidy("".join(t for t, _ in runs))
        if text:
            share = sum(_solid(t) for t, look in runs if look.get("b")) / max(1, _solid(text))
            out.append({
                "text": text, "styleId": name, "isBold": share >= 0.6, "isItalic": all(look.get("i", False) or not t.strip() for t, look in runs),
                "maxFontSize": max((look["sz"] for _, look in runs if look.get("sz")), default=None), "boldTextRatio": share,
            })
    return out


def parse_package(content: bytes) -> dict:
    """Paragraphs of the headers, the body and the footers; a package without its main part is an error."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = sorted(z.namelist())
        if "word/document.xml" not in names:
            raise ValueError("part not found: word/document.xml")
        read = z.read
        styles = _styles(read("word/styles.xml")) if "word/styles.xml" in names else {}
        many = lambda kind: [p for n in names if re.fullmatch(rf"word/{kind}\d+\.xml", n) for p in paragraphs(read(n), styles)]
        return {"headers": many("header"), "body": paragraphs(read("word/document.xml"), styles), "footers": many("footer")}


def parse(files: DataFrame) -> DataFrame:
    """path, headers, body, footers, error of rows (path, content); a broken package has an error and no paragraphs."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    rows.append({"path": path, **parse_package(bytes(content)), "error": None})
                except (ValueError, zipfile.BadZipFile, KeyError, ET.ParseError) as e:
                    rows.append({"path": path, "headers": [], "body": [], "footers": [], "error": str(e)})
            yield pd.DataFrame(rows, columns=["path", "headers", "body", "footers", "error"])

    return files.select("path", "content").mapInPandas(batches, SCHEMA)


def read_docx(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """All packages below ``path``; with ``strict`` a broken one is an error when it is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(path)
    out = parse(files)
    if not strict:
        return out
    bad = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("broken package "), "path", F.lit(": "), "error")))
    return out.withColumn("error", bad.cast("string"))


def issues_from_docx(parsed: DataFrame) -> DataFrame:
    """Rows for the segmentation: paragraphs, evidence (8 body lines, headers, footers), pages."""
    from scriptoria.operators.segment import clean_paragraphs, page_count

    lines = lambda c: F.transform(c, lambda p: p["text"])
    tidy = parsed.withColumn("paragraphs", clean_paragraphs(F.col("body")))
    evidence = F.concat(F.slice(lines("paragraphs"), 1, 8), lines("headers"), lines("footers"))
    return tidy.select(F.col("path").alias("issueId"), F.col("path").alias("sourcePath"), "paragraphs", evidence.alias("evidence"), page_count(lines("footers")).alias("pages"), F.lit("single-column").alias("layout"))


def issues_from_lines(paragraphs_: DataFrame, layouts: DataFrame) -> DataFrame:
    """The same rows from paragraphs (doc, place, text) of laid-out pages; the evidence is the first 12 lines."""
    p = F.struct(F.col("text"), F.lit(None).cast("string").alias("styleId"), F.lit(None).cast("boolean").alias("isBold"), F.lit(None).cast("boolean").alias("isItalic"), F.lit(None).cast("double").alias("maxFontSize"), F.lit(None).cast("double").alias("boldTextRatio"))
    rows = paragraphs_.groupBy("doc").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", p.alias("p")))), lambda x: x["p"]).alias("paragraphs"))
    rows = rows.join(layouts, "doc")
    return rows.select(F.col("doc").alias("issueId"), F.col("doc").alias("sourcePath"), "paragraphs", F.slice(F.transform("paragraphs", lambda x: x["text"]), 1, 12).alias("evidence"), F.col("pages").cast("int").alias("pages"), "layout")
