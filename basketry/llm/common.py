"""What several operators share: free column names, texts as bytes, line counts of tables."""

import ctypes

import numpy as np
import pyarrow as pa

MASK64 = (1 << 64) - 1
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def free_name(taken, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``taken`` has that name.

    Spark compares column names without regard to case, so this does too.
    """
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes, without decoding them."""
    return column.cast(pa.binary() if column.type != pa.large_string() else pa.large_binary()).to_pylist()


def give_back() -> None:
    """Returns to the system what Arrow and the C library keep of freed batches: a Python worker
    lives on after its task, beside an executor that needs the memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (the finaliser of the SplitMix64 generator)."""
    x = (x + GOLDEN).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shuffle_width(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
