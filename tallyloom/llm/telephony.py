"""Telephony audio: mu-law, A-law and IMA ADPCM to resampled 16-bit PCM."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_in_arrow, whole_text

PCM, MULAW, ALAW, ADPCM = 1, 7, 6, 17  # format tags of WAVE files
RATE_IN, RATE_OUT = 8000, 16000
#: Sample rates that are decoded; others, which a broken header may hold, give a reason.
RATES = range(1000, 768_001)
PAD, UNIT = 32, 192


def mulaw_table() -> np.ndarray:
    """Linear value of each mu-law code (ITU-T G.711): bias 132, inverted bits, 3 bits of exponent, 4 of mantissa."""
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    value = ((((code & 15) << 3) + 132) << (code >> 4 & 7)) - 132
    return np.where(code & 128, -value, value).astype(np.int16)


def alaw_table() -> np.ndarray:
    """Linear value of each A-law code (ITU-T G.711): even bits inverted, segment 0 is linear."""
    code = np.arange(256, dtype=np.int32) ^ 0x55
    segment = code >> 4 & 7
    value = ((code & 15) << 4) + 8
    value = np.where(segment > 0, (value + 256) << np.maximum(segment - 1, 0), value)
    return np.where(code & 128, value, -value).astype(np.int16)


def adpcm_steps() -> np.ndarray:
    """The 89 step sizes of IMA ADPCM. Fixed values."""
    return np.array([
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97,
        107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796,
        876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428,
        4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385,
        24623, 27086, 29794, 32767], dtype=np.int32)


LINEAR = {MULAW: mulaw_table(), ALAW: alaw_table()}
STEPS = adpcm_steps()
INDEX_MOVE = np.array([-1, -1, -1, -1, 2, 4, 6, 8], dtype=np.int32)


#: Blocks that are decoded at once, which bounds the memory.
BLOCKS_AT_ONCE = 1 << 13
#: Bytes of a block's header: its first sample, its index into the steps, one unused.
HEADER = 4


def decode_blocks(blocks: np.ndarray) -> np.ndarray:
    """A row of samples for each row of bytes. All blocks advance together, one nibble a step, each from its own header."""
    n, block = blocks.shape
    value = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2].astype(np.int32), len(STEPS) - 1)
    codes = np.empty((2 * (block - HEADER), n), np.uint8)
    codes[0::2], codes[1::2] = (blocks[:, HEADER:] & 15).T, (blocks[:, HEADER:] >> 4).T
    out = np.empty((1 + len(codes), n), np.int16)
    out[0] = value
    for k, code in enumerate(codes, 1):
        step = STEPS[index]
        move = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        value = np.clip(np.where(code & 8, value - move, value + move), -32768, 32767)
        index = np.clip(index + INDEX_MOVE[code & 7], 0, len(STEPS) - 1)
        out[k] = value
    return out.T


def decode_adpcm(data: bytes, block: int) -> np.ndarray:
    """Mono IMA ADPCM. A shorter last block is decoded as far as it goes; fewer bytes than a header hold no sample."""
    if block <= HEADER:
        raise ValueError(f"blocks of {block} bytes")
    n = len(data) // block
    blocks = np.frombuffer(data, np.uint8, n * block).reshape(n, block)
    parts = [decode_blocks(blocks[k : k + BLOCKS_AT_ONCE]).reshape(-1) for k in range(0, n, BLOCKS_AT_ONCE)]
    if len(data) - n * block >= HEADER:
        parts.append(decode_blocks(np.frombuffer(data, np.uint8, offset=n * block)[None, :]).reshape(-1))
    return np.concatenate(parts) if parts else np.zeros(0, np.int16)


def resample(pcm: np.ndarray, rate: int, to: int = RATE_OUT) -> np.ndarray:
    """Linear interpolation in whole numbers (rounded half up), so that every machine makes the same samples."""
    if len(pcm) == 0 or rate == to:
        return pcm
    n = max(1, len(pcm) * to // rate)
    at = np.arange(n, dtype=np.int64) * rate
    left, part = at // to, at % to
    a = pcm[left].astype(np.int64)
    b = pcm[np.minimum(left + 1, len(pcm) - 1)].astype(np.int64)
    return ((a * (to - part) + b * part + to // 2) // to).astype(np.int16)


def wave(data: bytes, tag: int, rate: int = RATE_IN, block: int = 1) -> bytes:
    """A mono WAVE file: one byte a sample, blocks (ADPCM) or 16-bit samples (PCM)."""
    if tag == PCM:
        block, bits, extra = 2, 16, b""
    elif tag == ADPCM:
        bits, extra = 4, struct.pack("<HH", 2, 2 * (block - HEADER) + 1)
    else:
        bits, extra = 8, struct.pack("<H", 0)
    fmt = struct.pack("<HHIIHH", tag, 1, rate, rate * block if tag == PCM else rate, block, bits) + extra
    pad = b"\0" * (len(data) % 2)
    body = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data + pad
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WAVE" + body


def read_wave(media: bytes) -> tuple[int, int, int, bytes]:
    """Format tag, sample rate, block size and stored bytes. Raises ValueError on anything but a mono WAVE file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAVE file")
    at, head = 12, None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if name == b"fmt ":
            if size < 16 or at + 24 > len(media):
                raise ValueError("a cut format chunk")
            tag, channels, rate, _, block, _ = struct.unpack("<HHIIHH", media[at + 8 : at + 24])
            if channels != 1:
                raise ValueError(f"{channels} channels")
            if rate not in RATES:
                raise ValueError(f"{rate} samples a second")
            head = tag, rate, block
        elif name == b"data" and head:
            return *head, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAVE file without samples")


def samples(data: bytes, tag: int, block: int) -> np.ndarray:
    """16-bit samples at the stored rate; of PCM an odd last byte is no sample."""
    if tag == ADPCM:
        return decode_adpcm(data, block)
    if tag == PCM:
        return np.frombuffer(data, "<i2", len(data) // 2).astype(np.int16)
    if tag in LINEAR:
        return LINEAR[tag][np.frombuffer(data, np.uint8)]
    raise ValueError(f"format tag {tag}")


def decode(media: bytes, to: int = RATE_OUT) -> np.ndarray:
    """16-bit PCM at the target rate."""
    tag, rate, block, data = read_wave(media)
    return resample(samples(data, tag, block), rate, to)


def feature(pcm: np.ndarray) -> str:
    """Number of samples, peak, mean absolute value (rounded down) and zero crossings."""
    if len(pcm) == 0:
        return "0:0:0:0"
    size = np.abs(pcm.astype(np.int32))
    positive = pcm >= 0
    return f"{len(pcm)}:{size.max()}:{int(size.sum(dtype=np.int64)) // len(pcm)}:{np.count_nonzero(positive[1:] != positive[:-1])}"


def decode_column(df: DataFrame, media_col: str = "media", pcm_col: str = "pcm", error_col: str = "media_error") -> DataFrame:
    """df with the resampled PCM (little-endian bytes) of a column of WAVE files. Null media give null; files that can't
    be read give null and a reason. Columns of df with these two names are replaced."""
    df = df.drop(pcm_col, error_col)
    schema = T.StructType([*df.schema.fields, T.StructField(pcm_col, T.BinaryType()), T.StructField(error_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # one file at a time bounds the memory
                row = batch.slice(k, 1)
                media, pcm, why = row.column(media_col)[0].as_py(), None, None
                if media is not None:
                    try:
                        pcm = decode(media).astype("<i2").tobytes()
                    except ValueError as e:
                        why = str(e)
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([pcm], pa.binary()), pa.array([why], pa.string())], names=schema.names)

    return map_in_arrow(df, run, schema)


def payload_of(text: bytes) -> bytes:
    return text + bytes([PAD]) * (-len(text) % UNIT or (UNIT if not text else 0))


#: Codecs in turn, by a checksum of the payload, so that equal texts are stored alike.
CODECS = (MULAW, ALAW, ADPCM)


def stored(payload: bytes, codecs: tuple[int, ...] = CODECS) -> bytes:
    """The payload's bytes as telephony samples; ADPCM takes UNIT bytes a block."""
    tag = codecs[zlib.crc32(payload) % len(codecs)]
    return wave(payload, tag, block=UNIT if tag == ADPCM else 1)


def text_to_media(df: DataFrame, text_col: str = "text", codecs: tuple[int, ...] = CODECS) -> DataFrame:
    """df with n_bytes and media: the text's bytes as telephony samples. Null counts as empty."""
    df = df.drop("n_bytes", "media")
    schema = T.StructType([*df.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column(text_col)]
            media = [stored(payload_of(x), codecs) for x in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([len(x) for x in texts], pa.int64()), pa.array(media, pa.binary())], names=schema.names)

    return map_in_arrow(df, run, schema)


def decoded(media: list[bytes]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Rate, stored bytes and samples of each file. The ADPCM files of one block size are decoded together."""
    heads = [read_wave(m) for m in media]
    joint: dict[int, np.ndarray] = {}
    for block in {b for tag, _, b, data in heads if tag == ADPCM and b > HEADER and len(data) % b == 0}:
        joint[block] = decode_adpcm(b"".join(d for tag, _, b, d in heads if tag == ADPCM and b == block and len(d) % b == 0), block)
    used = dict.fromkeys(joint, 0)
    for tag, rate, block, data in heads:
        if tag == ADPCM and block in joint and len(data) % block == 0:
            n = len(data) // block * (1 + 2 * (block - HEADER))
            yield rate, data, joint[block][used[block] : used[block] + n]
            used[block] += n
        else:
            yield rate, data, samples(data, tag, block)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm_bytes long, pcm_sha256 string"
#: Bytes of texts whose files are decoded together.
TOGETHER = 2 << 20


def media_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", codecs: tuple[int, ...] = CODECS) -> DataFrame:
    """Stores each text as telephony audio, reads the stored bytes back, decodes them, stores the resampled PCM as a file
    of its own, reads that and returns digests and features.

    One row per row of docs; null text counts as empty, null ids stay null, extra columns are ignored, an empty table
    gives an empty result. Texts go through in runs of about TOGETHER bytes, so memory follows the longest text and not
    the table."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, held, at = [], 0, 0
            for k in range(batch.num_rows + 1):
                if k == batch.num_rows or held > TOGETHER:
                    yield digests(batch.column(0).slice(at, k - at), raw)
                    raw, held, at = [], 0, k
                if k < batch.num_rows:
                    raw.append(batch.column(1)[k].as_buffer().to_pybytes())
                    held += len(raw[-1])

    def digests(ids: pa.Array, raw: list[bytes]) -> pa.RecordBatch:
        media, out = [stored(payload_of(x), codecs) for x in raw], []
        for x, file, (rate, payload, sound) in zip(raw, media, decoded(media)):
            pcm = wave(resample(sound, rate).astype("<i2").tobytes(), PCM, RATE_OUT)
            out.append((len(x), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(file), hashlib.sha256(file).hexdigest(), feature(decode(pcm)), len(pcm), hashlib.sha256(pcm).hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 9, kinds))], names=[x.split()[0] for x in DIGEST.split(", ")])

    return map_in_arrow(rows, run, DIGEST)
