"""CSV files of unknown make, logs that grow, and progress marks."""

from __future__ import annotations

import codecs
import csv
import json
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENCODINGS = ("utf-8-sig", "utf-8", "cp1252", "latin1")
DELIMITERS = ",;\t|"
HEAD = 1 << 16


def encoding_of(path: str) -> str:
    """The first of ENCODINGS that decodes the whole file, read in pieces of HEAD bytes."""
    for encoding in ENCODINGS:
        decoder = codecs.getincrementaldecoder(encoding)()
        try:
            with open(path, "rb") as f:
                while piece := f.read(HEAD):
                    decoder.decode(piece)
            decoder.decode(b"", True)
            return encoding
        except UnicodeDecodeError:
            continue
    raise ValueError(f"no encoding decodes {path}")


def sniff(path: str) -> tuple[str, str]:
    """(encoding, delimiter): the encoding by the whole file, the delimiter by its first bytes, or the one most used in the header where sniffing fails."""
    encoding = encoding_of(path)
    with open(path, "rb") as f:
        raw = f.read(HEAD)
    text = codecs.getincrementaldecoder(encoding)().decode(raw)  # leaves out a character cut by the sample's end
    if encoding == "utf-8-sig" and not raw.startswith(b"\xef\xbb\xbf"):
        encoding = "utf-8"
    try:
        return encoding, csv.Sniffer().sniff(text, DELIMITERS).delimiter
    except csv.Error:
        header = text.split("\n", 1)[0]
        return encoding, max(DELIMITERS, key=header.count)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with its encoding and delimiter found out; all columns as text."""
    encoding, delimiter = sniff(path)
    names = {"utf-8-sig": "UTF-8", "utf-8": "UTF-8", "cp1252": "ISO-8859-1", "latin1": "ISO-8859-1"}
    df = spark.read.option("header", True).option("sep", delimiter).option("encoding", names[encoding]).option("multiLine", True).option("escape", '"').csv(path)
    if encoding == "cp1252":  # Spark lacks it: its bytes 0x80 to 0x9F differ from ISO-8859-1
        pairs = [(chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
        source, target = ("".join(x) for x in zip(*pairs))
        df = df.select(*(F.translate(F.col(f"`{c}`"), source, target).alias(c.translate(str.maketrans(source, target))) for c in df.columns))
    return df.withColumnsRenamed({c: c.lstrip("\ufeff").strip() for c in df.columns})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def append_new(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Append the rows whose keys the table at path lacks; what was appended."""
    spark = df.sparkSession
    try:
        done = spark.read.parquet(path).select(*keys).distinct()
        df = df.join(done, keys, "left_anti")
    except Exception as e:  # nothing is there yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    fresh = df.dropDuplicates(keys)
    fresh.write.mode("append").parquet(path)
    return fresh


def save_progress(path: str, last: int, at: str) -> None:
    """Replace the mark in one step, so that a reader sees the old or the new one."""
    with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(path) or ".", delete=False) as f:
        json.dump({"last_committed_article_id": last, "updated_at": at}, f)
    os.replace(f.name, path)


def load_progress(path: str) -> int | None:
    try:
        with open(path) as f:
            return json.load(f)["last_committed_article_id"]
    except (FileNotFoundError, ValueError, KeyError):
        return None


def audit(rows: DataFrame, old: str = "old_published_at", new: str = "new_published_at") -> DataFrame:
    """rows with the ``status`` of a repair: filled, changed, same, or kept."""
    status = F.when(F.col(new).isNull(), "KEPT").when(F.col(old).isNull(), "FILLED").when(F.col(old) == F.col(new), "SAME").otherwise("CHANGED")
    return rows.withColumn("status", status)
