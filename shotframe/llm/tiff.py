"""Media columns: TIFF files in a binary column. The reader walks the image directories, decodes PackBits, LZW
or deflate strips and tiles, undoes predictors and gives one row per page; a writer makes such files."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the TIFF 6.0 format: compression schemes, tags, bytes of each field type.
NONE, LZW, DEFLATE, DEFLATE_OLD, PACKBITS = 1, 5, 8, 32946, 32773
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
CLEAR, END = 256, 257
_RUN = re.compile(rb"(.)\1{2,127}", re.DOTALL)


def unpack_bits(data: bytes) -> bytes:
    out, i = [], 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out.append(data[i + 1 : i + 2 + n])
            i += 2 + n
        else:
            if n > 128:
                out.append(data[i + 1 : i + 2] * (257 - n))
            i += 2 if n > 128 else 1
    return b"".join(out)


def pack_bits(data: bytes) -> bytes:
    out = []

    def literal(part: bytes) -> None:
        for i in range(0, len(part), 128):
            out.append(bytes([len(part[i : i + 128]) - 1]) + part[i : i + 128])

    at = 0
    for m in _RUN.finditer(data):
        literal(data[at : m.start()])
        out.append(bytes([257 - (m.end() - m.start())]) + m[1])
        at = m.end()
    literal(data[at:])
    return b"".join(out)


def lzw_decode(data: bytes, need: int | None = None) -> bytes:
    """Codes of 9 to 12 bits, high bits first; a code grows longer one entry before the table needs it. Ends when
    there are need bytes; ValueError on a code that the table does not have yet."""
    first = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, bits, n, last, out, made = first[:], 9, 0, 0, None, [], 0
    for byte in data:
        bits = (bits << 8 | byte) & 0xFFFFFF
        n += 8
        if n < width:
            continue
        n -= width
        code = bits >> n & (1 << width) - 1
        if code == CLEAR:
            table, width, last = first[:], 9, None
        elif code == END:
            break
        else:
            if code > len(table) or code == len(table) and (last is None or len(table) >= 4096):
                raise ValueError(f"LZW code {code} beyond the table")
            if last is None:
                entry = table[code]
            else:
                entry = table[code] if code < len(table) else last + last[:1]
                table.append(last + entry[:1])
                if len(table) == (1 << width) - 1 and width < 12:
                    width += 1
            out.append(entry)
            last = entry
            made += len(entry)
            if need is not None and made >= need:
                break
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    out, bits, n, width = bytearray(), CLEAR, 9, 9

    def put(code: int) -> None:
        nonlocal bits, n
        bits = bits << width | code
        n += width
        if n >= 64:
            spare = n % 8
            out.extend((bits >> spare).to_bytes(n // 8, "big"))
            bits &= (1 << spare) - 1
            n = spare

    first = {bytes([i]): i for i in range(256)}
    table, size, w = first.copy(), 258, b""
    for i in range(len(data)):
        grown = w + data[i : i + 1]
        if grown in table:
            w = grown
            continue
        put(table[w])
        table[grown] = size
        size += 1
        if size == 1 << width:
            width += 1
        if size == 4095:
            put(CLEAR)
            table, size, width = first.copy(), 258, 9
        w = data[i : i + 1]
    if w:
        put(table[w])
        size += 1
        if size == 1 << width and width < 12:
            width += 1
    put(END)
    pad = -n % 8
    out.extend((bits << pad).to_bytes((n + pad) // 8, "big"))
    return bytes(out)


def _decoded(data: bytes, scheme: int, need: int) -> bytes:
    """The need bytes of a strip or tile."""
    if scheme == NONE:
        out = data
    elif scheme == LZW:
        out = lzw_decode(data, need)
    elif scheme in (DEFLATE, DEFLATE_OLD):
        out = zlib.decompressobj().decompress(data, max(1, need))
    elif scheme == PACKBITS:
        out = unpack_bits(data)
    else:
        raise ValueError(f"compression {scheme} is not read")
    if len(out) < need:
        raise ValueError(f"a strip or tile has {len(out)} of {need} bytes")
    return out[:need]


def _block(raw: bytes, rows: int, width: int, samples: int, kind: np.dtype, bits: int, predictor: int) -> np.ndarray:
    """Rows, columns and samples of a decoded strip or tile, its predictor undone; samples of less than a byte get
    one each."""
    if bits < 8:
        if predictor != 1:
            raise ValueError(f"predictor {predictor} over {bits} bits a sample is not undone")
        flat = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(rows, -1)[:, : width * samples * bits].reshape(rows, width, samples, bits)
        return flat @ (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)
    if predictor == 3:  # bytes of a row's samples, most significant first in planes, as differences
        size = bits // 8
        if size == 1:
            raise ValueError("predictor 3 needs samples of 16 bits or more")
        planes = np.cumsum(np.frombuffer(raw, np.uint8).reshape(rows, -1, samples), axis=1, dtype=np.uint8).reshape(rows, size, width * samples)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">u{size}").reshape(rows, width, samples).astype(f"=u{size}")
    a = np.frombuffer(raw, kind).reshape(rows, width, samples).astype(kind.newbyteorder("="))
    if predictor == 2:
        return np.cumsum(a, axis=1, dtype=a.dtype)
    if predictor != 1:
        raise ValueError(f"predictor {predictor} is not undone")
    return a


def _directory(data: bytes, order: str, at: int) -> tuple[dict[int, tuple], int]:
    """Tags of the directory at a place, and where the next one is."""
    (n,) = struct.unpack_from(order + "H", data, at)
    tags: dict[int, tuple] = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        size = TYPE_BYTES.get(kind, 1) * count
        place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
        if kind in (1, 3, 4) and place + size <= len(data):
            tags[tag] = struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind] }".replace(" ", ""), data, place)
    return tags, struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


FILL_ORDER, SAMPLE_FORMAT = 266, 339
#: Bytes with their bits turned round: how a page of the second fill order keeps them.
REVERSED = bytes(int(f"{x:08b}"[::-1], 2) for x in range(256))


def _page(data: bytes, order: str, tags: dict[int, tuple]) -> dict:
    one = lambda tag, default=None: tags[tag][0] if tags.get(tag) else default
    width, height, bits, spp = one(WIDTH), one(HEIGHT), one(BITS, 1), one(SAMPLES, 1)
    scheme, predictor, planar = one(COMPRESSION, NONE), one(PREDICTOR, 1), one(PLANAR, 1) == 2 and spp > 1
    if not width or not height or not spp:
        raise ValueError("a page without width, height or samples")
    if bits not in (1, 2, 4, 8, 16, 32, 64) or len(set(tags.get(BITS, (8,)))) > 1:
        raise ValueError(f"bits a sample {tags.get(BITS)} are not read")
    kind = np.dtype(f"{order}u{max(1, bits // 8)}")
    tiled = TILE_OFFSETS in tags
    offsets, counts = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if tiled else (tags[STRIP_OFFSETS], tags[STRIP_COUNTS])
    w, h = (one(TILE_WIDTH), one(TILE_HEIGHT)) if tiled else (width, min(one(ROWS_PER_STRIP, height), height))
    if not w or not h:
        raise ValueError("strips or tiles without size")
    if width * height * spp * max(1, bits // 8) > 4096 * (sum(counts) + 1):  # beyond what any scheme can pack into them
        raise ValueError(f"{width} x {height} samples in {sum(counts)} bytes")
    across, down = -(-width // w), -(-height // h)
    planes, own = (spp, 1) if planar else (1, spp)
    if len(offsets) != across * down * planes or len(counts) != len(offsets):
        raise ValueError(f"{len(offsets)} strips or tiles of {across * down * planes}")
    image = np.zeros((height, width, spp), kind.newbyteorder("<"))
    for k, (a, b) in enumerate(zip(offsets, counts, strict=True)):
        plane, place = divmod(k, across * down)
        top, left = place // across * h, place % across * w
        rows = h if tiled else min(h, height - top)
        stored = data[a : a + b].translate(REVERSED) if one(FILL_ORDER, 1) == 2 else data[a : a + b]
        raw = _decoded(stored, scheme, rows * -(-w * own * bits // 8))
        block = _block(raw, rows, w, own, kind, bits, predictor)[: height - top, : width - left]
        image[top : top + block.shape[0], left : left + block.shape[1], plane : plane + own] = block
    return {"width": width, "height": height, "bits": bits, "samples_per_pixel": spp, "compression": scheme, "predictor": predictor, "sample_format": one(SAMPLE_FORMAT, 1), "samples": image.tobytes()}


#: What damaged bytes can raise.
DAMAGE = (ValueError, KeyError, IndexError, TypeError, OverflowError, ZeroDivisionError, MemoryError, struct.error, zlib.error)


def pages(data: bytes) -> Iterator[dict]:
    """Each page: width, height, bits, samples_per_pixel, compression, predictor, sample_format (1 unsigned, 2 signed, 3
    floating, as the file says), samples (rows of pixels of little-endian samples; of less than 8 bits, a byte each); or, of a page that cannot be read, error. A
    damaged chain of directories ends with such a page. ValueError or struct.error on what is no TIFF file."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if not order or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("no TIFF file")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        try:
            if at in seen:
                raise ValueError("the directories form a ring")
            seen.add(at)
            tags, after = _directory(data, order, at)
        except DAMAGE as e:
            yield {"error": f"{type(e).__name__}: {e}"[:200]}
            return
        try:
            yield _page(data, order, tags)
        except DAMAGE as e:
            yield {"error": f"{type(e).__name__}: {e}"[:200]}
        at = after


def tiff(samples: bytes, width: int = 64, page_rows: int = 2048, compression: int = DEFLATE, predictor: int = 2, tiles: bool = False, strip_rows: int = 512) -> bytes:
    """A file of 8-bit grey pages with the samples in row order; their number is a multiple of width."""
    pack = {NONE: bytes, LZW: lzw_encode, DEFLATE: lambda x: zlib.compress(x, 1), PACKBITS: pack_bits}[compression]
    whole = np.frombuffer(samples, np.uint8).reshape(-1, width)
    link = 4
    out = bytearray(struct.pack("<2sHI", b"II", 42, 0))
    for top in range(0, max(1, len(whole)), page_rows):
        page = whole[top : top + page_rows]
        if tiles:
            w, h = -(-min(width, 256) // 16) * 16, 256
            padded = np.zeros((-(-len(page) // h) * h, -(-width // w) * w), np.uint8)
            padded[: len(page), :width] = page
            blocks = [padded[y : y + h, x : x + w] for y in range(0, padded.shape[0], h) for x in range(0, padded.shape[1], w)]
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, len(page), strip_rows)]
        places, sizes = [], []
        for b in blocks:
            if predictor == 2:
                b = np.diff(b, axis=1, prepend=np.uint8(0))
            z = pack(np.ascontiguousarray(b).tobytes())
            places.append(len(out))
            sizes.append(len(z))
            out += z
        if len(out) % 2:
            out += b"\0"
        lists = {}
        for name, values in (("places", places), ("sizes", sizes)):
            lists[name] = values[0] if len(values) == 1 else len(out)
            if len(values) > 1:
                out += struct.pack(f"<{len(values)}I", *values)
        fields = [(WIDTH, 1, width), (HEIGHT, 1, len(page)), (BITS, 1, 8), (COMPRESSION, 1, compression), (PHOTOMETRIC, 1, 1)]
        if not tiles:
            fields += [(STRIP_OFFSETS, len(blocks), lists["places"]), (SAMPLES, 1, 1), (ROWS_PER_STRIP, 1, strip_rows), (STRIP_COUNTS, len(blocks), lists["sizes"])]
        else:
            fields += [(SAMPLES, 1, 1), (TILE_WIDTH, 1, w), (TILE_HEIGHT, 1, h), (TILE_OFFSETS, len(blocks), lists["places"]), (TILE_COUNTS, len(blocks), lists["sizes"])]
        fields = sorted([*fields, (PREDICTOR, 1, predictor)])
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", tag, 4, n, value) for tag, n, value in fields)
        link = len(out)
        out += struct.pack("<I", 0)
    return bytes(out)


PAGE = "page int, n_pages int, width int, height int, bits int, samples_per_pixel int, compression int, predictor int, sample_format int, samples binary, error string"


def tiff_pages(df: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per page of the TIFF file in media_col, in order, with the columns keep of its row.

    page counts from 0. A page that cannot be read has its reason in error and null samples; a null file, or
    one that is no TIFF file, gives one row with null page and the reason. Repeated rows give their pages each,
    an empty table none. A kept column that is called like one of the result gets _kept behind its name;
    other columns are not read. Narrow: pages stay beside their file's."""
    own = {x.split()[0] for x in PAGE.split(", ")}
    kept = df.select(*(F.col(c).alias(f"{c}_kept" if c in own else c) for c in keep), F.col(media_col).cast("binary").alias("media"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]), PAGE])
    names = [x.split()[0] for x in PAGE.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, rows, size = [], [], 0

            def batch(index: list, rows: list) -> pa.RecordBatch:
                at = pa.array(index, pa.int64())
                own = [pa.array([r.get(k) for r in rows], pa.binary() if k == "samples" else pa.string() if k == "error" else pa.int32()) for k in names]
                return pa.RecordBatch.from_arrays([*(c.take(at) for c in b.columns[:-1]), *own], [*b.schema.names[:-1], *names])  # noqa: B023

            for i, data in enumerate(b.column(b.num_columns - 1)):
                data = data.as_py()
                try:
                    if data is None:
                        raise ValueError("null")
                    found = list(pages(data))
                    found = [p | {"page": k, "n_pages": len(found)} for k, p in enumerate(found)] or [{"error": "no page"}]
                except DAMAGE as e:
                    found = [{"error": f"{type(e).__name__}: {e}"[:200]}]
                index += [i] * len(found)
                rows += found
                size += sum(len(p.get("samples", b"")) for p in found)
                if size > 8 << 20:
                    yield batch(index, rows)
                    index, rows, size = [], [], 0
            if rows:
                yield batch(index, rows)

    return kept.mapInArrow(read, schema)


def text_media(docs: DataFrame, width: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every whole text (null: empty) as a TIFF file of 8-bit samples: UTF-8, zeros up to a positive
    multiple of width. Returns id, n_bytes and media. The scheme depends on the payload alone, so that equal
    texts give equal files and every scheme is in use: one in sixteen LZW, one PackBits, two deflate
    tiles, the others deflate strips. A row for each row: null ids stay null, repeated rows are stored each, an
    empty table gives none. Other columns are not read."""
    from .common import text_chunks

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in text_chunks(batches, 4 << 20):
            files = []
            for t in texts:
                payload = t + b"\0" * (-len(t) % width if t else width)
                kind = zlib.crc32(payload) % 16
                files.append(tiff(payload, width, compression={0: LZW, 1: PACKBITS}.get(kind, DEFLATE), predictor=1 if kind == 1 else 2, tiles=kind in (2, 3)))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(files, pa.binary())], ["id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(stored, "id long, n_bytes long, media binary").withColumnRenamed("id", id_col)


def page_digests(read: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Of each file whose pages tiff_pages gave, one row: the columns keep, payload_bytes, payload_sha256,
    tail_crc32 (of the last 64 bytes), feature (mean, deviation, entropy and roughness of the samples) and
    error. A file with a page that could not be read has the first reason in error and nulls for the rest. Null
    and repeated rows give a row each, an empty table none. The pages of a file follow each other, so nothing
    is shuffled or gathered."""
    from hashlib import sha256

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in read.select(*keep).schema.fields), "payload_bytes long, payload_sha256 string, tail_crc32 long, feature string, error string"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, sha, tail, histogram, rough, bad = 0, None, b"", None, 0, None
        for b in batches:
            at, rows = [], []
            col = {k: b.column(b.schema.get_field_index(k)) for k in ("page", "n_pages", "samples", "error")}
            for i, (page, n, samples, error) in enumerate(zip(*(x.to_pylist() for x in col.values()), strict=True)):
                if page is None or page == 0:
                    size, sha, tail, histogram, rough, bad = 0, sha256(), b"", np.zeros(256, np.int64), 0, None
                bad = bad or error
                if bad:
                    if page is None or page == n - 1:
                        at.append(i)
                        rows.append((None, None, None, None, bad))
                    continue
                a = np.frombuffer(samples, np.uint8)
                size += len(a)
                sha.update(samples)
                tail = (tail + samples)[-64:]
                histogram += np.bincount(a, minlength=256)
                rough += int(np.abs(np.diff(a.astype(np.int16))).sum(dtype=np.int64))
                if page == n - 1:
                    share = histogram / max(1, size)
                    mean = float(share @ np.arange(256))
                    dev = float(np.sqrt(max(0.0, share @ np.square(np.arange(256) - mean))))
                    some = share[share > 0]
                    at.append(i)
                    rows.append((size, sha.hexdigest(), zlib.crc32(tail), f"{mean:.4f};{dev:.4f};{-float(some @ np.log2(some)):.4f};{rough / max(1, size):.4f}", None))
            if rows:
                index = pa.array(at, pa.int64())
                own = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(k)).take(index) for k in keep), *own], [*keep, "payload_bytes", "payload_sha256", "tail_crc32", "feature", "error"])

    return read.select(*keep, "page", "n_pages", "samples", "error").mapInArrow(digest, schema)
