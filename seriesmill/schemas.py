"""Column layouts shared by batch and streaming jobs.

Times are LONG nanoseconds since the Unix epoch: Spark's TIMESTAMP keeps only microseconds.
"""

from __future__ import annotations

from pyspark.sql import types as T

SECOND = 1_000_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR


BOOL, INT, LONG, DOUBLE = T.BooleanType(), T.IntegerType(), T.LongType(), T.DoubleType()
STRING, BINARY = T.StringType(), T.BinaryType()
INTS, LONGS = T.ArrayType(INT), T.ArrayType(LONG)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CHANNEL_KEY = ("backend", "channel", "scalar_type", "shape_dims")

EVENTS = struct(
    series=LONG, ts_ns=LONG, seq=LONG, pulse=LONG, scalar_type=STRING, shape_dims=INTS, value=DOUBLE
)

REGISTRY = struct(
    series=LONG, backend=STRING, channel=STRING, scalar_type=INT, shape_dims=INTS, agg_kind=INT
)

CAPTURE = struct(msg_id=LONG, source=STRING, recv_ts_ns=LONG, frames=T.ArrayType(BINARY))

MAIN_HEADER = struct(
    htype=STRING,
    hash=STRING,
    pulse_id=STRING,
    global_timestamp=struct(sec=LONG, ns=LONG),
    dh_compression=STRING,
)

CHANNEL_DESC = struct(name=STRING, type=STRING, shape=INTS, encoding=STRING, compression=STRING)

DATA_HEADER = struct(htype=STRING, channels=T.ArrayType(CHANNEL_DESC))

CA_FRAME = struct(
    seq=LONG, recv_ts_ns=LONG, cmdid=INT, data_type=INT, data_count=INT, param1=LONG, param2=LONG, payload=BINARY
)

LIFECYCLE = struct(channel=STRING, ts_ns=LONG, event=STRING, addr=STRING)

# Sentinel scalar type of a channel's status series.
STATUS_SCALAR_TYPE = -(2**31) + 1

# Numbers of the scalar types in registry keys.
SCALAR_TYPE_CODES = {
    "U8": 0, "U16": 1, "U32": 2, "U64": 3, "I8": 4, "I16": 5, "I32": 6, "I64": 7,
    "F32": 8, "F64": 9, "BOOL": 10, "STRING": 11, "ENUM": 12,
}

# Connection status codes.
CONNECTION_STATUS = [
    (1, "ConnectError"),
    (2, "ConnectTimeout"),
    (3, "Established"),
    (4, "Closing"),
    (5, "ClosedUnexpected"),
    (6, "ConnectionHandlerDone"),
]

# Channel status codes; the second name is the reason of a close.
CHANNEL_STATUS = [
    (1, "Opened", None),
    (2, "Closed", "ShutdownCommand"),
    (3, "Closed", "ChannelRemove"),
    (4, "Closed", "ProtocolError"),
    (5, "Closed", "FrequencyQuota"),
    (6, "Closed", "BandwidthQuota"),
    (7, "Closed", "InternalError"),
    (8, "Closed", "IocTimeout"),
    (9, "Closed", "NoProtocol"),
    (10, "Closed", "ProtocolDone"),
    (24, "AssignedToAddress", None),
]

# Scalar types of Channel Access request type ids, in id order within each block of seven.
CA_SCALAR_TYPES = ["STRING", "I16", "F32", "ENUM", "I8", "I32", "F64"]
CA_META = ["plain", "status", "time"]

# Padding between the time metadata and the value of time-type messages.
CA_TIME_PADDING = {"STRING": 0, "I16": 2, "F32": 0, "ENUM": 2, "I8": 3, "I32": 0, "F64": 4}

# Seconds from 1970-01-01 to 1990-01-01, the epoch of device times.
EPICS_EPOCH_OFFSET = 631_152_000

# Default port of a device address without one.
CA_PORT = 5064
