"""What a Python worker keeps between tasks: loaded models and bounded caches."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """The value of ``key`` in this worker, made when it is first asked for; a new kind drops others."""
    values = _values()
    if key not in values:
        drop(key[0])
        values[key] = make()
    return values[key]


def drop(but: str | None = None) -> None:
    """Forget what earlier stages left in this worker, except for keys that begin with ``but``."""
    values = _values()
    for key in [k for k in values if k[0] != but]:
        del values[key]


def _values() -> dict[tuple, Any]:
    module = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker"))
    return module.__dict__.setdefault("values", {})


def slices(batch: pa.RecordBatch, text: int, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``rows`` rows and, but for a single longer one, ``size`` bytes of column ``text``."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    at, used = 0, 0
    for i, n in enumerate(lengths):
        if i > at and (i - at == rows or used + n > size):
            yield batch.slice(at, i - at)
            at, used = i, 0
        used += n
    if at < batch.num_rows:
        yield batch.slice(at)
