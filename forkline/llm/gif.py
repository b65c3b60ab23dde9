"""GIF media columns: payloads stored as timed frames, read back by a full LZW, palette, disposal and transparency decoder."""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import add_columns, documents

#: Samples in a row of a stored frame, rows in a frame, and hundredths of a second that it stays.
WIDTH, ROWS, DELAY = 64, 256, 4
#: Codes of 12 bits at most.
MAX_CODES = 4096
HIST_BINS = 8


# ---- code streams -------------------------------------------------------------------------------


def _widths(bits: int, first_free: int, n: int) -> np.ndarray:
    """Bits of each of the n codes after a clear code. The decoder's table lags one entry behind."""
    free = np.arange(n) + first_free - 1  # entries defined when code k is read; the first defines none
    free[0:1] = first_free
    free = np.minimum(free, MAX_CODES)
    w = np.full(n, bits + 1)
    for b in range(bits + 1, 12):
        w[free >= (1 << b)] = b + 1
    return w


@functools.lru_cache(16)
def _plan(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Widths of the first 8192 codes after a clear code, and the bits before each."""
    w = _widths(bits, (1 << bits) + 2, MAX_CODES * 2)
    return w, np.concatenate(([0], np.cumsum(w)))


def _pack(codes: np.ndarray, widths: np.ndarray) -> bytes:
    """Codes to bytes, lowest bit first."""
    places = np.arange(12, dtype=np.uint16)
    bits = (codes.astype(np.uint16)[:, None] >> places) & 1
    return np.packbits(bits[places < widths[:, None]].astype(np.uint8), bitorder="little").tobytes()


def lzw_encode(data: bytes, bits: int = 8) -> bytes:
    """The code stream of data, whose samples have `bits` bits; the table is cleared when it is full."""
    clear, end = 1 << bits, (1 << bits) + 1
    first, room = clear + 2, MAX_CODES - 1
    segments: list[list[int]] = []
    rest = iter(data)
    prefix = next(rest, None)
    while prefix is not None:
        table: dict[int, int] = {}
        codes: list[int] = []
        put, look, free = codes.append, table.get, first
        for b in rest:
            key = prefix << 8 | b
            code = look(key)
            if code is None:
                put(prefix)
                table[key] = free
                free += 1
                prefix = b
                if free == room:
                    break
            else:
                prefix = code
        put(prefix)
        segments.append(codes)
        prefix = next(rest, None)
    all_codes, all_widths = [], []
    width_before = bits + 1
    for codes in segments:
        all_codes.append(np.concatenate(([clear], codes)))
        w = _plan(bits)[0][: len(codes) + 1]  # one more: the width of what follows
        all_widths.append(np.concatenate(([width_before], w[:-1])))
        width_before = int(w[-1])
    if not segments:
        all_codes.append(np.array([clear]))
        all_widths.append(np.array([bits + 1]))
    all_codes.append(np.array([end]))
    all_widths.append(np.array([width_before]))
    return _pack(np.concatenate(all_codes), np.concatenate(all_widths))


def _strings(codes: np.ndarray, clear: int) -> np.ndarray:
    """Samples of the codes between two clear codes.

    The string of a table entry is that of the code before it and one sample more, so it stands in the output already: an entry made
    after code m begins where code m's string begins. Lengths and samples follow their references by pointer doubling.
    """
    n = len(codes)
    made_after = codes - (clear + 2)  # the code whose string an entry repeats
    refers = codes >= clear
    wrong = refers & ((made_after < 0) | (made_after >= np.arange(n)))
    if wrong.any():
        raise ValueError(f"code {int(codes[wrong][0])} isn't defined yet")
    up = np.where(refers, made_after, np.arange(n))
    length = refers.astype(np.int64)
    while True:
        further = up[up]
        if np.array_equal(further, up):
            break
        length += np.where(up != np.arange(n), length[up], 0)
        up = further
    length += 1
    start = np.cumsum(length) - length
    total = int(length.sum())
    offset = np.arange(total) - np.repeat(start, length)
    at = np.where(np.repeat(refers, length), np.repeat(start[np.where(refers, made_after, 0)], length) + offset, np.arange(total))
    while True:
        further = at[at]
        if np.array_equal(further, at):
            break
        at = further
    samples = np.repeat(codes, length)
    return samples[at].astype(np.uint8)


def lzw_decode(stream: bytes, bits: int, most: int) -> bytes:
    """Samples of a code stream, `most` at most; ends at the end code, at the stream's end or when full.

    Between clear codes, the width of a code depends on its place alone, so codes are unpacked in one vectorised step.
    """
    clear, end = 1 << bits, (1 << bits) + 1
    raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    n_bits, at = 8 * len(stream), 0
    out: list[bytes] = []
    size = 0
    widths, plan = _plan(bits)
    while at + bits + 1 <= n_bits and size < most:
        k = min(int(np.searchsorted(plan, n_bits - at, side="right")) - 1, MAX_CODES * 2)
        pos = plan[:k] + at
        byte = pos >> 3
        word = raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16
        codes = ((word >> (pos & 7).astype(np.uint32)) & ((1 << widths[:k]).astype(np.uint32) - 1)).astype(np.int64)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else k
        if stop:
            part = _strings(codes[:stop], clear)
            out.append(part.tobytes())
            size += len(part)
        if stop == k:  # no stop code in sight: the stream ends, or the table stays full for long
            if k < MAX_CODES * 2:
                break
            raise ValueError("no clear code in 8192 codes")
        at += int(plan[stop + 1])
        if int(codes[stop]) == end:
            break
    return b"".join(out)[:most]


# ---- the container ------------------------------------------------------------------------------


@dataclass
class Frame:
    """One image of a file: its place, samples, palette and how it is shown."""

    left: int
    top: int
    width: int
    height: int
    samples: bytes
    palette: np.ndarray | None
    delay: int = 0
    disposal: int = 0
    transparent: int | None = None


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes((len(x),)) + x for x in (data[i : i + 255] for i in range(0, len(data), 255))) + b"\0"


def encode_gif(payload: bytes, width: int = WIDTH, rows: int = ROWS, delay: int = DELAY) -> bytes:
    """A GIF whose samples are the payload's bytes, row by row; the global palette is grey, sample i being (i, i, i).

    Frames of `rows` rows follow each other, the last may be lower. len(payload) is a positive multiple of width.
    """
    if not payload or len(payload) % width:
        raise ValueError("the payload must fill rows")
    high = len(payload) // width
    out = [b"GIF89a", struct.pack("<HHBBB", width, min(rows, high), 0xF7, 0, 0), bytes(v for i in range(256) for v in (i, i, i))]
    for lo in range(0, high, rows):
        n = min(rows, high - lo)
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, delay, 0) + b"\0")
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, width, n, 0) + b"\x08" + _blocks(lzw_encode(payload[lo * width : (lo + n) * width])))
    return b"".join([*out, b"\x3b"])


def _palette(data: bytes, at: int, flags: int) -> tuple[np.ndarray | None, int]:
    if not flags & 0x80:
        return None, at
    n = 2 << (flags & 7)
    return np.frombuffer(data, np.uint8, 3 * n, at).reshape(n, 3), at + 3 * n


def _rows_in_order(samples: bytes, width: int, height: int) -> bytes:
    """Rows of an interlaced image from top to bottom: passes from 0, 4, 2 and 1 in steps of 8, 8, 4 and 2."""
    rows = np.frombuffer(samples, np.uint8).reshape(height, width)
    order = [y for start, step in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(start, height, step)]
    out = np.empty_like(rows)
    out[order] = rows
    return out.tobytes()


def read_gif(data: bytes) -> tuple[int, int, int, list[Frame]]:
    """Canvas width and height, background sample and all frames of a file."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags, background, _ = struct.unpack_from("<HHBBB", data, 6)
    common, at = _palette(data, 13, flags)
    frames: list[Frame] = []
    delay, disposal, transparent = 0, 0, None

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while n := data[at]:
            parts.append(data[at + 1 : at + 1 + n])
            at += 1 + n
        return b"".join(parts), at + 1

    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            label = data[at + 1]
            body, at = blocks(at + 2)
            if label == 0xF9:
                how, delay, index = struct.unpack_from("<BHB", body)
                disposal, transparent = how >> 2 & 7, index if how & 1 else None
        elif data[at] == 0x2C:
            left, top, w, h, how = struct.unpack_from("<HHHHB", data, at + 1)
            own, at = _palette(data, at + 10, how)
            bits = data[at]
            stream, at = blocks(at + 1)
            samples = lzw_decode(stream, bits, w * h)
            samples += b"\0" * (w * h - len(samples))
            if how & 0x40:
                samples = _rows_in_order(samples, w, h)
            frames.append(Frame(left, top, w, h, samples, own if own is not None else common, delay, disposal, transparent))
            delay, disposal, transparent = 0, 0, None
        else:
            raise ValueError(f"no block starts with byte {data[at]}")
    return width, height, background, frames


def compose(width: int, height: int, frames: list[Frame]):
    """Yield each frame's canvas (height x width x RGBA) as shown, by the transparency and disposal rules.

    Disposal 2 clears the frame's place, 3 brings back what was there before it; all else leaves it.
    """
    canvas = np.zeros((height, width, 4), np.uint8)
    for f in frames:
        place = np.s_[f.top : f.top + f.height, f.left : f.left + f.width]
        before = canvas[place].copy()
        seen = before.shape[:2]
        index = np.frombuffer(f.samples, np.uint8).reshape(f.height, f.width)[: seen[0], : seen[1]]
        colours = np.zeros((256, 4), np.uint8)
        if f.palette is not None:
            colours[: len(f.palette), :3] = f.palette
            colours[: len(f.palette), 3] = 255
        drawn = colours[index]
        if f.transparent is not None:
            drawn = np.where((index == f.transparent)[..., None], before, drawn)
        canvas[place] = drawn
        yield canvas.copy()
        if f.disposal == 2:
            canvas[place] = 0
        elif f.disposal == 3:
            canvas[place] = before


# ---- columns ------------------------------------------------------------------------------------


def padded(text: str | None, unit: int = WIDTH) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % unit if raw else unit), len(raw)


STORED = [T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())]
FRAMES = T.ArrayType(T.StructType([T.StructField("start_cs", T.LongType()), T.StructField("delay_cs", T.IntegerType()), T.StructField("samples", T.BinaryType()), T.StructField("histogram", T.ArrayType(T.IntegerType()))]))
FEATURES = [
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_sha256", T.StringType()),
    T.StructField("tail_crc32", T.LongType()),
    T.StructField("media_bytes", T.LongType()),
    T.StructField("media_sha256", T.StringType()),
    T.StructField("feature", T.StringType()),
]


def histogram(canvas: np.ndarray) -> list[int]:
    """Pixels per bin of red, then green, then blue, of what is shown; transparent pixels count nowhere."""
    shown = canvas[canvas[..., 3] > 0]
    counts = [np.bincount(shown[:, c] // (256 // HIST_BINS), minlength=HIST_BINS) for c in range(3)]
    return np.concatenate(counts).tolist()


def frame_histograms(width: int, height: int, frames: list[Frame]) -> list[list[int]]:
    """The histogram of each frame's canvas.

    A frame that covers the canvas without transparency shows its own samples, so its counts follow from theirs and the palette.
    """

    def covers(f: Frame) -> bool:
        return not f.left and not f.top and f.width == width and f.height == height and f.transparent is None and f.palette is not None and len(f.palette) == 256 and f.disposal < 2

    if not all(covers(f) for f in frames[:-1]):
        return [histogram(c) for c in compose(width, height, frames)]
    out = []
    for f in frames:
        if covers(f):
            n = np.bincount(np.frombuffer(f.samples, np.uint8), minlength=256)
            bins = f.palette // (256 // HIST_BINS)
            out.append(np.concatenate([np.bincount(bins[:, c], weights=n, minlength=HIST_BINS) for c in range(3)]).astype(int).tolist())
        else:
            *_, last = compose(width, height, frames[-2:])
            out.append(histogram(last))
    return out


def store_payloads(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append n_bytes and media: the text as UTF-8, filled with bytes 0 to a positive multiple of 64, as a GIF.

    A null or empty text gives one row of zeros. Equal texts give equal media. Other columns stay.
    """

    def make():
        def f(values: list) -> list[list]:
            both = [padded(v) for v in values]
            return [[n for _, n in both], [encode_gif(p) for p, _ in both]]

        return f

    return add_columns(docs, text_col, STORED, make)


def read_frames(media: DataFrame, media_col: str = "media") -> DataFrame:
    """Append frames: start and delay in hundredths of a second, samples, and the shown canvas's colour histogram. Null media have none."""

    def one(data: bytes | None) -> list[dict] | None:
        if data is None:
            return None
        width, height, _, frames = read_gif(data)
        out, start = [], 0
        for f, counts in zip(frames, frame_histograms(width, height, frames), strict=True):
            out.append({"start_cs": start, "delay_cs": f.delay, "samples": f.samples, "histogram": counts})
            start += f.delay
        return out

    return add_columns(media, media_col, [T.StructField("frames", FRAMES)], lambda: lambda values: [[one(v) for v in values]])


def payload_features(media: DataFrame, media_col: str = "media") -> DataFrame:
    """Append the digests of payloads read back from stored media, and a feature: frames, duration and summed histogram of red."""

    def one(data: bytes) -> tuple:
        width, height, _, frames = read_gif(data)
        total = np.sum(frame_histograms(width, height, frames), axis=0, dtype=np.int64)
        payload = b"".join(f.samples for f in frames)
        feature = f"frames={len(frames)};cs={sum(f.delay for f in frames)};hist={','.join(map(str, total[:HIST_BINS].tolist()))}"
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest(), feature

    return add_columns(media, media_col, FEATURES, lambda: lambda values: [list(x) for x in zip(*map(one, values), strict=True)])


def op9_gif(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store every document as a GIF, read the stored bytes back and digest them."""
    stored = store_payloads(documents(spark, sf_dir)).drop("text")
    return payload_features(stored).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
