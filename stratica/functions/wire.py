"""Schema-registry wire frames: one zero byte, a 4-byte schema id, then an Avro record body.

The contracts are records of nullable strings, whose body is, per field, branch 0 for null or
branch 1 followed by a zig-zag length and UTF-8 bytes. Encoding is a native expression.
Decoding uses Spark's own Avro function when that module is on the class path, otherwise an
Arrow-batched function with the same fail-fast behaviour.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wire layout (fixed values).
MAGIC_BYTE_HEX = "00"
HEADER_BYTES = 5
NULL_BRANCH_HEX = "00"
STRING_BRANCH_HEX = "02"


def _length_hex(byte_length: Column) -> Column:
    """Zig-zag varint of a byte length, as hex digits (lengths are below 2**31)."""
    zigzag = byte_length.cast("long") * 2

    def digits(count: int) -> Column:
        """Low seven bits first, every byte but the last with its high bit set."""
        value = F.shiftright(zigzag, 7 * (count - 1))
        for i in range(count - 1):
            group = F.shiftright(zigzag, 7 * i).bitwiseAND(0x7F).bitwiseOR(0x80)
            value = value.bitwiseOR(F.shiftleft(group, 8 * (count - 1 - i)))
        return F.lpad(F.hex(value), 2 * count, "0")

    chain = F.when(zigzag < (1 << 7), digits(1))
    for count in (2, 3, 4):
        chain = chain.when(zigzag < (1 << (7 * count)), digits(count))
    return chain.otherwise(digits(5))


def _field(c: Column) -> Column:
    raw = c.cast("binary")
    head = F.concat(F.lit(STRING_BRANCH_HEX), _length_hex(F.octet_length(raw)))
    return F.when(c.isNull(), F.unhex(F.lit(NULL_BRANCH_HEX))).otherwise(F.concat(F.unhex(head), raw))


def encode_frame(columns: list[Column], schema_id: int) -> Column:
    """Binary frame of nullable string columns, in contract order.

    One expression applied to every field in turn: spelling it out per field would outgrow the
    method size codegen can handle on wide contracts. The fields are then joined at once, so no byte is
    copied more than once for its field and once for the frame.
    """
    header = F.unhex(F.lit(f"{MAGIC_BYTE_HEX}{schema_id:08x}"))
    fields = F.transform(F.array(*columns), _field)
    return F.transform(F.array(fields), lambda all_: F.concat(header, *[all_[i] for i in range(len(columns))]))[0]


def frame_body(value: Column) -> Column:
    """The Avro body: everything after the header."""
    return F.substring(value, HEADER_BYTES + 1, 2147483647)


def avro_schema(contract: T.StructType, name: str) -> str:
    """The contract as Avro JSON: a record of nullable strings with null defaults."""
    fields = [{"name": n, "type": ["null", "string"], "default": None} for n in contract.names]
    return json.dumps({"type": "record", "name": name, "fields": fields})


def _bodies(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The batch's bytes in one piece, and where each frame's body starts and ends in it; absent frames are empty."""
    large = column.cast(pa.large_binary())
    _, offsets, data = large.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[large.offset : large.offset + len(large) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw, ends[:-1].copy(), ends[1:]


def _next_field(raw: np.ndarray, at: np.ndarray, end: np.ndarray, live: np.ndarray) -> pa.Array:
    """One field of every live frame; ``at`` moves on. Frames advance together, a step per byte of a length."""
    def byte() -> np.ndarray:
        if (at[live] >= end[live]).any():
            raise ValueError("malformed frame: it ends inside a field")
        found = raw[at[live]].astype(np.int64)
        at[live] += 1
        return found

    branch = np.zeros(len(at), dtype=np.int64)
    branch[live] = byte()
    if ((branch != 0) & (branch != 2)).any():
        raise ValueError("malformed frame: unknown union branch")
    present = live & (branch == 2)
    length, shift, live = np.zeros(len(at), dtype=np.int64), 0, present
    while live.any():
        found = byte()
        length[live] |= (found & 0x7F) << shift
        shift += 7
        live = live.copy()
        live[live] = found >= 0x80
    length >>= 1
    start = at.copy()
    at[present] += length[present]
    if (at > end).any() or (length < 0).any():
        raise ValueError("malformed frame: value runs past the end")
    # the values' bytes, gathered into one buffer
    size = np.where(present, length, 0)
    offsets = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - start, size)
    values = pa.LargeStringArray.from_buffers(
        len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw[place])),
        pa.py_buffer(np.packbits(present, bitorder="little")),
    )
    values.validate(full=True)
    return values.cast(pa.string())


def _arrow_decoder(names: list[str]):
    schema = pa.schema([(n, pa.string()) for n in names])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at, end = _bodies(batch.column(0))
            live = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            columns = [_next_field(raw, at, end, live) for _ in names]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return decode


def has_avro(spark: SparkSession) -> bool:
    try:
        spark.range(0).select(F.expr("from_avro(X'00', '\"null\"', map())")).schema
        return True
    except AnalysisException:
        return False


def decode_frames(frames: DataFrame, contract: T.StructType, value: str = "value") -> DataFrame:
    """Frames to contract columns: strip the header, read the body, expand the record.

    A frame without a value (a tombstone) gives a row of nulls; a malformed one fails the job.
    """
    body = frame_body(F.col(value)).alias("body")
    if has_avro(frames.sparkSession):
        from pyspark.sql.avro.functions import from_avro

        record = from_avro(F.col("body"), avro_schema(contract, "record"))
        return frames.select(body).select(record.alias("record")).select("record.*")
    return frames.select(body).mapInArrow(_arrow_decoder(contract.names), contract)
