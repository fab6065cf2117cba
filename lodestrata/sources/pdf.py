"""Words of documents: a pluggable extractor over binary files, one row per word with its place and font."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

WORDS = "document_id string, page int, text string, x0 double, x1 double, top double, bottom double, size double, fontname string, parse_error string"


def plumber_words(content: bytes) -> Iterable[dict]:
    """Words by the optional library pdfplumber, where it is installed."""
    try:
        import io

        import pdfplumber
    except ImportError as e:
        raise RuntimeError("pdfplumber isn't installed; give an extractor") from e
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        for n, page in enumerate(pdf.pages, 1):
            for w in page.extract_words(x_tolerance=1, y_tolerance=3, extra_attrs=["size", "fontname"]):
                yield {**{k: w[k] for k in ("text", "x0", "x1", "top", "bottom", "size", "fontname")}, "page": n}


def words_of(files: DataFrame, extractor: Callable[[bytes], Iterable[dict]] = plumber_words, key: str = "sha256") -> DataFrame:
    """Words of ``files(key, content)``; a file that is no PDF, fails or has no words gives one row with ``parse_error`` and nothing else."""
    names = [f.split()[0] for f in WORDS.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                error, words = None, []
                if not content or not content.startswith(b"%PDF"):
                    error = "not_a_pdf"
                else:
                    try:
                        words = list(extractor(content))
                        error = None if words else "no_words"
                    except Exception as e:
                        error = f"{type(e).__name__}: {e}"[:500]
                rows = [{**w, "document_id": doc} for w in words] if error is None else [{"document_id": doc, "parse_error": error}]
                types = {"page": pa.int32(), **dict.fromkeys(("x0", "x1", "top", "bottom", "size"), pa.float64())}
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], types.get(n, pa.string())) for n in names], names)

    return files.select(key, "content").mapInArrow(emit, WORDS)
