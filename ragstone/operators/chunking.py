"""Pages to clean text to chunks with stable ids and content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragstone.functions import text


def clean_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``body`` (clean text) and ``content_hash``; pages without a body go."""
    body = text.normalise_text(text.strip_html(F.col(html)))
    return pages.withColumn("body", body).filter("body <> ''").withColumn("content_hash", text.content_hash(F.col("body")))


def simple_windows(x: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters every ``size - overlap``, stripped, empty ones dropped.

    The text is cut into steps once and windows are put together from steps, so long texts cost
    linear time.
    """
    if size <= 0 or not 0 <= overlap < size:
        raise ValueError(f"need size > 0 and 0 <= overlap < size, not {size} and {overlap}")
    step = size - overlap
    steps = F.regexp_extract_all(x, F.lit(f"(?s).{{1,{step}}}"), 0)
    window = lambda s, i: text.strip(F.left(F.array_join(F.slice(s, i + 1, -(-size // step)), ""), F.lit(size)))
    # The steps are an element of an array here, else they were cut anew for every window.
    windows = F.element_at(F.transform(F.array(steps), lambda s: F.transform(s, lambda _, i: window(s, i))), 1)
    return F.filter(windows, lambda w: w != "")


def recursive_split(x: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Split at the first separator that occurs, merge pieces up to ``size`` with ``overlap``, recurse into larger ones."""
    found = next((i for i, s in enumerate(separators) if s == "" or s in x), len(separators) - 1)
    sep, rest = separators[found], separators[found + 1 :]
    out: list[str] = []
    window: list[str] = []
    length = 0

    def flush() -> None:
        if joined := sep.join(window).strip():
            out.append(joined)

    for piece in filter(None, x.split(sep) if sep else list(x)):
        if len(piece) >= size:
            if window:
                flush()
                window.clear()
                length = 0
            out += recursive_split(piece, size, overlap, rest) if rest else [piece]
            continue
        if window and length + len(sep) + len(piece) > size:
            flush()
            while window and (length > overlap or length + len(sep) + len(piece) > size):
                length -= len(window.pop(0)) + (len(sep) if window else 0)
        length += len(piece) + (len(sep) if window else 0)
        window.append(piece)
    if window:
        flush()
    return out


def recursive_windows(x: Column, size: int, overlap: int, separators: Sequence[str] = ("\n\n", "\n", ". ", " ", "")) -> Column:
    @F.udf(T.ArrayType(T.StringType()), useArrow=True)
    def split(value):
        return None if value is None else recursive_split(value, size, overlap, separators)

    return split(x)


SPLITTERS = {"simple": simple_windows, "recursive": recursive_windows}


def chunk_pages(pages: DataFrame, splitter: str = "simple", size: int = 200, overlap: int = 40, separators: Sequence[str] | None = None) -> DataFrame:
    """chunk_id, page_path, chunk_index, text, content_hash of ``pages`` (base_path, body); ``separators`` are for the recursive splitter."""
    if splitter not in SPLITTERS:
        raise ValueError(f"unknown splitter {splitter!r}")
    more = (separators,) if separators and splitter == "recursive" else ()
    pieces = SPLITTERS[splitter](F.col("body"), size, overlap, *more)
    rows = pages.select(F.col("base_path").alias("page_path"), F.posexplode(pieces).alias("chunk_index", "text")).filter("text <> ''")
    chunk_id = F.concat(text.page_path_id(F.col("page_path")), F.lit("#chunk-"), F.col("chunk_index").cast("string"))
    return rows.select(chunk_id.alias("chunk_id"), "page_path", "chunk_index", "text", text.content_hash(F.col("text")).alias("content_hash"))


def raw_body(details: Column) -> Column:
    """The body of a raw content item and those of its parts, a blank line between."""
    return F.concat_ws("\n\n", details["body"], F.transform(details["parts"], lambda p: p["body"]))
