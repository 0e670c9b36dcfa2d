"""Files through the usual PDF tools, where they are installed: profile, text by page, and OCR.

Each tool runs on the executors, one file at a time, with a time limit; its path is a parameter.
Without it the call fails before any file is read. Files are rows with binary content.
"""

from __future__ import annotations

import shutil
import subprocess
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import split_pages


class ToolMissing(RuntimeError):
    """A program that the step needs isn't installed here."""


def require(tool: str) -> str:
    if (found := shutil.which(tool)) is None:
        raise ToolMissing(tool)
    return found


def _run(command: list[str], timeout: float) -> tuple[str | None, str | None]:
    """(output, None) or (None, why there is none)."""
    try:
        done = subprocess.run(command, capture_output=True, text=True, timeout=timeout, errors="replace")
    except (OSError, subprocess.TimeoutExpired) as e:
        return None, f"{type(e).__name__}: {e}"
    return (done.stdout, None) if done.returncode == 0 else (None, f"code {done.returncode}: {done.stderr[:300]}")


def _each(df: DataFrame, key: str, content: str, schema: str, work: Callable[[str], tuple]) -> DataFrame:
    """One row per file: its key and what ``work`` makes of a scratch copy, which lives as long as the call."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for ident, raw in zip(batch[key], batch[content], strict=True):
                with tempfile.TemporaryDirectory() as scratch:
                    path = Path(scratch) / "in.pdf"
                    path.write_bytes(raw or b"")
                    rows.append((ident, *work(str(path))))
            yield pd.DataFrame(rows, columns=[c.strip().split(" ")[0] for c in schema.split(",")])

    return df.select(key, content).mapInPandas(run, schema)


def profiles(df: DataFrame, key: str = "id", content: str = "content", tool: str = "pdfinfo", timeout: float = 120) -> DataFrame:
    """(id, pages, producer, creator, failed): what the file says about itself."""
    program = require(tool)

    def work(path: str) -> tuple:
        said, failed = _run([program, path], timeout)
        found = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in (said or "").splitlines())}
        pages = found.get("pages", "")
        return int(pages) if pages.isdigit() else None, found.get("producer") or None, found.get("creator") or None, failed

    kind = dict(df.dtypes)[key]
    return _each(df, key, content, f"{key} {kind}, pages int, producer string, creator string, failed string", work)


def page_texts(df: DataFrame, key: str = "id", content: str = "content", tool: str = "pdftotext", timeout: float = 120) -> DataFrame:
    """(id, pages array<string>, failed): the text of each page in layout order."""
    program = require(tool)
    kind = dict(df.dtypes)[key]
    raw = _each(df, key, content, f"{key} {kind}, text string, failed string", lambda path: _run([program, "-layout", path, "-"], timeout))
    return raw.select(key, split_pages(F.col("text")).alias("pages"), "failed")


def ocr(df: DataFrame, key: str = "id", content: str = "content", tool: str = "ocrmypdf", language: str = "spa", timeout: float = 900) -> DataFrame:
    """(id, content, failed): the file with a text layer made anew."""
    program = require(tool)
    kind = dict(df.dtypes)[key]

    def work(path: str) -> tuple:
        out = f"{path}.out"
        _, failed = _run([program, "--force-ocr", "-l", language, path, out], timeout)
        return (None, failed) if failed else (Path(out).read_bytes(), None)

    return _each(df, key, content, f"{key} {kind}, {content} binary, failed string", work)
