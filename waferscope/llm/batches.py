"""Arrow batches taken up in parts of bounded size, so that a few very long texts do not decide a task's memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def slices(texts: pa.StringArray, size: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of about `size` bytes of a column without nulls, or of one longer text: where each begins, and its texts."""
    ends = np.cumsum(np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)), dtype=np.int64) if len(texts) else np.empty(0)
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
        yield start, texts.slice(start, end - start).to_pylist()
        start = end
