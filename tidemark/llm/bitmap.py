"""A set of hashes as a bitmap of bounded size: members are always found, others seldom."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
SLICE_BITS = 16


def _slice(table: pa.Table) -> pa.Table:
    bits = np.zeros(1 << SLICE_BITS, bool)
    place = table.column("place").to_numpy()
    bits[place & ((1 << SLICE_BITS) - 1)] = True
    schema = pa.schema([("slice", pa.int64()), ("bits", pa.binary())])
    return pa.table({"slice": [int(place[0]) >> SLICE_BITS], "bits": [np.packbits(bits).tobytes()]}, schema)


def bitmap(hashes: DataFrame, count: int, most: int, width: int = 64) -> bytes:
    """One of the single column of ``hashes`` by their upper bits, in 16 bits or more for each of ``count``, 2 ** ``most`` at most.

    ``width``: how many bits of a hash there are. Tasks make slices of 8 KB, and only these go to the driver.
    """
    bits = min(most, max(SLICE_BITS, (16 * count).bit_length()))
    place = F.shiftrightunsigned(hashes.columns[0], width - bits)
    slices = hashes.select(place.alias("place"), F.shiftright(place, SLICE_BITS).alias("slice"))
    out = np.zeros((1 << (bits - SLICE_BITS), 1 << (SLICE_BITS - 3)), np.uint8)
    for part, data in slices.groupBy("slice").applyInArrow(_slice, "slice long, bits binary").collect():
        out[part] = np.frombuffer(data, np.uint8)
    return out.tobytes()


class Members:
    def __init__(self, data: bytes):
        self.bits = np.frombuffer(data, np.uint8)
        self.shift = U64(64 - (8 * len(self.bits)).bit_length() + 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes >> self.shift).astype(np.int64)
        return (self.bits[place >> 3] >> (7 - (place & 7)) & 1).astype(bool)
