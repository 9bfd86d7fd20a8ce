"""Bytes of volume and image files to arrays and back; standard library and numpy only."""

from __future__ import annotations

import base64
import gzip
import io
import json
import struct
import zlib
from dataclasses import dataclass, field
from xml.etree import ElementTree

import numpy as np

from ..operators.geometry import IDENTITY, Geometry


@dataclass
class Grid:
    """values in z, y, x order (or components last), with geometry and what the file says of itself."""

    values: np.ndarray
    geometry: Geometry = field(default_factory=Geometry)
    meta: dict = field(default_factory=dict)


#: NIfTI-1 data type codes: fixed values of the format.
NIFTI_TYPES = {2: "u1", 4: "i2", 8: "i4", 16: "f4", 64: "f8", 256: "i1", 512: "u2", 768: "u4", 1024: "i8", 1280: "u8"}
#: VTK scalar names and numpy types: fixed values of the format.
VTK_TYPES = {"Int8": "i1", "UInt8": "u1", "Int16": "i2", "UInt16": "u2", "Int32": "i4", "UInt32": "u4", "Int64": "i8", "UInt64": "u8", "Float32": "f4", "Float64": "f8"}


@dataclass
class NiftiHeader:
    """shape in z, y, x order; order: byte order; code: number type; values are slope * number + inter."""

    shape: tuple[int, int, int]
    order: str
    code: int
    offset: int
    slope: float
    inter: float
    geometry: Geometry


def nifti_header(body: bytes, orientation: bool = True) -> NiftiHeader:
    """From the first 352 bytes of a file; with orientation=False spacing and origin only."""
    order = "<" if struct.unpack_from("<i", body)[0] == 348 else ">"
    if struct.unpack_from(f"{order}i", body)[0] != 348:
        raise ValueError("not a NIfTI-1 file")
    dims = struct.unpack_from(f"{order}8h", body, 40)
    shape = [n for n in dims[1 : dims[0] + 1]]
    while len(shape) > 3 and shape[-1] == 1:
        shape.pop()
    if len(shape) != 3:
        raise ValueError(f"expected three dimensions, got {shape}")
    code = struct.unpack_from(f"{order}h", body, 70)[0]
    pix = struct.unpack_from(f"{order}8f", body, 76)
    offset, slope, inter = struct.unpack_from(f"{order}3f", body, 108)
    qform, sform = struct.unpack_from(f"{order}2h", body, 252)
    if sform > 0:
        affine = [list(struct.unpack_from(f"{order}4f", body, 280 + 16 * r)) for r in range(3)]
    elif qform > 0:
        b, c, d, *shift = struct.unpack_from(f"{order}6f", body, 256)
        a = max(0.0, 1 - b * b - c * c - d * d) ** 0.5
        rot = [[a * a + b * b - c * c - d * d, 2 * (b * c - a * d), 2 * (b * d + a * c)], [2 * (b * c + a * d), a * a + c * c - b * b - d * d, 2 * (c * d - a * b)], [2 * (b * d - a * c), 2 * (c * d + a * b), a * a + d * d - b * b - c * c]]
        size = [pix[1], pix[2], pix[3] * (-1 if pix[0] < 0 else 1)]
        affine = [[rot[r][k] * size[k] for k in range(3)] + [shift[r]] for r in range(3)]
    else:
        affine = [[pix[r + 1] if r == k else 0.0 for k in range(3)] + [0.0] for r in range(3)]
    g = Geometry.from_affine(affine)
    return NiftiHeader(tuple(shape[::-1]), order, code, int(offset), slope, inter, g if orientation else Geometry(g.spacing, g.origin))


def decode_nifti(body: bytes, orientation: bool = True) -> Grid:
    """A NIfTI-1 file, gzipped or not, as float32."""
    if body[:2] == b"\x1f\x8b":
        body = gzip.decompress(body)
    h = nifti_header(body, orientation)
    raw = np.frombuffer(body, np.dtype(h.order + NIFTI_TYPES[h.code]), int(np.prod(h.shape)), h.offset).astype(np.float32)
    if h.slope not in (0.0, 1.0) or h.inter:
        raw = raw * np.float32(h.slope or 1.0) + np.float32(h.inter)
    return Grid(raw.reshape(h.shape), h.geometry, {"original_dtype": NIFTI_TYPES[h.code]})


def encode_nifti(grid: Grid, compress: bool = False) -> bytes:
    v = np.ascontiguousarray(grid.values, "<f4")
    head = bytearray(352)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, 3, *v.shape[::-1], 1, 1, 1, 1)
    struct.pack_into("<2h", head, 70, 16, 32)
    struct.pack_into("<8f", head, 76, 1, *grid.geometry.spacing, 0, 0, 0, 0)
    struct.pack_into("<3f", head, 108, 352, 1, 0)
    struct.pack_into("<2h", head, 252, 0, 1)
    for r in range(3):
        struct.pack_into("<4f", head, 280 + 16 * r, *(grid.geometry.direction[r][k] * grid.geometry.spacing[k] for k in range(3)), grid.geometry.origin[r])
    head[344:348] = b"n+1\0"
    body = bytes(head) + v.tobytes()
    return gzip.compress(body) if compress else body


def parse_direction(value) -> tuple[tuple[float, ...], ...]:
    """None: identity; nine numbers or three rows of three."""
    if value is None:
        return IDENTITY
    flat = np.asarray(json.loads(value) if isinstance(value, str) else value, float)
    if flat.shape not in ((9,), (3, 3)):
        raise ValueError(f"direction needs nine numbers, got shape {flat.shape}")
    return tuple(tuple(r) for r in flat.reshape(3, 3).tolist())


def decode_raw(body: bytes, shape, dtype: str = "uint16", endian: str = "<", order: str = "zyx", offset: int = 0) -> np.ndarray:
    """Plain numbers; order "xyz" means that z runs fastest."""
    if shape is None or len(shape) != 3:
        raise ValueError("shape needs three sizes")
    kind = np.dtype(dtype).newbyteorder(endian)
    n = int(np.prod(shape))
    if len(body) - offset < n * kind.itemsize:
        raise ValueError(f"expected {n} values, the file has {(len(body) - offset) // kind.itemsize}")
    flat = np.frombuffer(body, kind, n, offset)
    return flat.reshape(shape) if order == "zyx" else flat.reshape(tuple(reversed(tuple(shape)))).transpose(2, 1, 0)


def _blocks(raw: bytes, head: str, compressed: bool) -> bytes:
    size = struct.calcsize(head)
    if not compressed:
        n = struct.unpack_from(head, raw)[0]
        return raw[size : size + n]
    count = struct.unpack_from(head, raw)[0]
    sizes = struct.unpack_from(f"{head[0]}{count}{head[1]}", raw, 3 * size)
    at, out = (3 + count) * size, []
    for n in sizes:
        out.append(zlib.decompress(raw[at : at + n]))
        at += n
    return b"".join(out)


def _from_base64(text: str, head: str, compressed: bool) -> bytes:
    text = "".join(text.split())
    if not compressed:
        return _blocks(base64.b64decode(text), head, False)
    size = struct.calcsize(head)
    count = struct.unpack_from(head, base64.b64decode(text[: -(-size // 3) * 4]))[0]
    first = -(-(3 + count) * size // 3) * 4  # the header is encoded apart from the data
    return _blocks(base64.b64decode(text[:first])[: (3 + count) * size] + base64.b64decode(text[first:]), head, True)


@dataclass
class VtiArray:
    name: str | None
    association: str
    type: str
    components: int
    format: str
    offset: int
    text: str | None


@dataclass
class VtiHeader:
    """shape: points in z, y, x order; order: byte order; head: struct format of a block's length."""

    shape: tuple[int, int, int]
    order: str
    head: str
    compressed: bool
    geometry: Geometry
    arrays: list[VtiArray]
    active: str | None

    @property
    def head_bytes(self) -> int:
        return struct.calcsize(self.head)

    def choose(self, name: str | None = None) -> VtiArray:
        """The point array of the name, else the cell array of the name, else the active or the first point array, else the first cell array."""
        for kind in ("point", "cell"):
            own = [a for a in self.arrays if a.association == kind]
            if name is not None and (hit := [a for a in own if a.name == name]):
                return hit[0]
        for kind in ("point", "cell"):
            if own := [a for a in self.arrays if a.association == kind]:
                return next((a for a in own if kind == "point" and a.name == self.active), own[0])
        raise ValueError("no point or cell array")


def vti_header(text: bytes) -> VtiHeader:
    """From the XML of a VTK image, without its appended data."""
    root = ElementTree.fromstring(text)
    order = "<" if root.get("byte_order", "LittleEndian") == "LittleEndian" else ">"
    image = root.find("ImageData")
    ext = [int(x) for x in image.get("WholeExtent").split()]
    nx, ny, nz = (ext[2 * i + 1] - ext[2 * i] + 1 for i in range(3))
    floats = lambda name, default: tuple(float(x) for x in image.get(name, default).split())
    d = floats("Direction", "1 0 0 0 1 0 0 0 1")
    arrays, points = [], image.find("Piece/PointData")
    for kind, part in (("point", points), ("cell", image.find("Piece/CellData"))):
        for a in part.findall("DataArray") if part is not None else ():
            arrays.append(VtiArray(a.get("Name"), kind, a.get("type"), int(a.get("NumberOfComponents") or 1), a.get("format", "ascii"), int(a.get("offset") or 0), a.text))
    g = Geometry(floats("Spacing", "1 1 1"), floats("Origin", "0 0 0"), (d[:3], d[3:6], d[6:]))
    return VtiHeader((nz, ny, nx), order, order + ("Q" if root.get("header_type") == "UInt64" else "I"), bool(root.get("compressor")), g, arrays, points.get("Scalars") if points is not None else None)


def to_points(cells: np.ndarray) -> np.ndarray:
    """Values at the corners of cells (z, y, x and perhaps components): means of the up to eight cells around."""
    total = np.zeros([n + 1 for n in cells.shape[:3]] + list(cells.shape[3:]))
    times = np.zeros(total.shape)
    nz, ny, nx = cells.shape[:3]
    for z in (0, 1):
        for y in (0, 1):
            for x in (0, 1):
                total[z : z + nz, y : y + ny, x : x + nx] += cells
                times[z : z + nz, y : y + ny, x : x + nx] += 1
    return total / times


def decode_vti(body: bytes, array: str | None = None, magnitude: bool = False) -> Grid:
    """A VTK XML image: ascii, inline or appended data, raw or base64, plain or zlib. For the array see VtiHeader.choose; cell values go to the points
    around. magnitude: of an array of several components the Euclidean length."""
    at = body.find(b"<AppendedData")
    appended, encoding = b"", "raw"
    text = body
    if at >= 0:
        mark = body.index(b"_", body.index(b">", at))
        encoding = "base64" if b'"base64"' in body[at:mark] else "raw"
        appended = body[mark + 1 : body.rindex(b"</AppendedData>")]
        text = body[:at] + b"</VTKFile>"
    h = vti_header(text)
    a = h.choose(array)
    kind = np.dtype(h.order + VTK_TYPES[a.type])
    if a.format == "ascii":
        flat = np.array((a.text or "").split(), kind)
    elif a.format == "binary":
        flat = np.frombuffer(_from_base64(a.text, h.head, h.compressed), kind)
    else:
        flat = np.frombuffer(_blocks(appended[a.offset :], h.head, h.compressed) if encoding == "raw" else _from_base64(appended[a.offset :].decode(), h.head, h.compressed), kind)
    shape = h.shape if a.association == "point" else tuple(max(n - 1, 1) for n in h.shape)
    if len(flat) != int(np.prod(shape)) * a.components:
        raise ValueError(f"{len(flat)} values for {' x '.join(map(str, reversed(shape)))}")
    values = flat.reshape(shape if a.components == 1 else (*shape, a.components))
    if a.association == "cell":
        values = to_points(values)[tuple(slice(n) for n in h.shape)]
    if magnitude and a.components > 1:
        values = np.sqrt((values.astype(np.float64) ** 2).sum(axis=-1))
    return Grid(values, h.geometry, {"array": a.name, "association": a.association, "original_dtype": kind.str[1:]})


def vti_frame(shape, dtype, geometry: Geometry, array: str = "Scalars") -> tuple[bytes, bytes]:
    """What stands before and after the numbers (little-endian, x fastest) in a file of raw appended data."""
    kind = np.dtype(dtype)
    ext = " ".join(f"0 {n - 1}" for n in reversed(shape))
    text = lambda xs: " ".join(repr(float(x)) for x in xs)
    g = geometry
    head = (
        f'<?xml version="1.0"?>\n<VTKFile type="ImageData" version="1.0" byte_order="LittleEndian" header_type="UInt64">\n<ImageData WholeExtent="{ext}" Origin="{text(g.origin)}" Spacing="{text(g.spacing)}" Direction="{text(x for r in g.direction for x in r)}">\n'
        f'<Piece Extent="{ext}"><PointData Scalars="{array}"><DataArray type="{dict((t, n) for n, t in VTK_TYPES.items())[kind.str[1:]]}" Name="{array}" format="appended" offset="0"/></PointData><CellData/></Piece></ImageData>\n<AppendedData encoding="raw">\n_'
    ).encode()
    return head + struct.pack("<Q", int(np.prod(shape)) * kind.itemsize), b"\n</AppendedData>\n</VTKFile>\n"


def encode_vti(grid: Grid, array: str = "Scalars") -> bytes:
    v = grid.values
    if v.ndim != 3:
        raise ValueError("only scalar volumes can be written")
    head, tail = vti_frame(v.shape, v.dtype, grid.geometry, array)
    return head + np.ascontiguousarray(v).astype(v.dtype.newbyteorder("<")).tobytes() + tail


def decode_png(body: bytes) -> np.ndarray:
    """An 8-bit PNG (gray, RGB, palette, with or without alpha; not interlaced) as rows x columns x RGBA, 0..255."""
    if body[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG file")
    at, data, palette, alpha = 8, [], None, b""
    while at < len(body):
        n, kind = struct.unpack_from(">I4s", body, at)
        chunk = body[at + 8 : at + 8 + n]
        at += 12 + n
        if kind == b"IHDR":
            w, h, depth, colour, _, _, lace = struct.unpack(">IIBBBBB", chunk)
            if depth != 8 or lace:
                raise ValueError("only 8-bit PNG files without interlacing")
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            alpha = chunk
        elif kind == b"IDAT":
            data.append(chunk)
    step = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(h, 1 + w * step)
    out = np.zeros((h, w * step), np.uint8)
    up = np.zeros(w * step, np.int64)
    for y in range(h):
        method, line = raw[y, 0], raw[y, 1:].astype(np.int64)
        if method == 2:
            line = line + up
        elif method == 1:
            line = np.cumsum(line.reshape(w, step), axis=0).ravel()
        elif method:
            for i in range(w * step):
                left, corner = (line[i - step], up[i - step]) if i >= step else (0, 0)
                if method == 3:
                    line[i] += (left + up[i]) // 2
                else:
                    p = left + up[i] - corner
                    near = min((abs(p - left), 0, left), (abs(p - up[i]), 1, up[i]), (abs(p - corner), 2, corner))
                    line[i] += near[2]
                line[i] &= 255
        up = line & 255
        out[y] = up
    px = out.reshape(h, w, step)
    full = np.full((h, w, 1), 255, np.uint8)
    if colour == 3:
        a = np.full(len(palette), 255, np.uint8)
        a[: len(alpha)] = np.frombuffer(alpha, np.uint8)
        return np.concatenate([palette[px[..., 0]], a[px[..., 0]][..., None]], axis=2)
    if step == 1 or step == 2:
        return np.concatenate([px[..., :1]] * 3 + [px[..., 1:] if step == 2 else full], axis=2)
    return px if step == 4 else np.concatenate([px, full], axis=2)


def encode_png(rgba: np.ndarray) -> bytes:
    h, w, n = rgba.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(rgba, np.uint8).reshape(h, w * n)], axis=1).tobytes()
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 2: 4, 3: 2, 4: 6}[n], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def unit_scale(rgba: np.ndarray) -> np.ndarray:
    """Float32 in 0..1: divided by 255 only if some value, alpha included, is above 1."""
    x = rgba.astype(np.float32)
    return x / 255 if x.size and x.max() > 1 else x


def encode_npz(columns: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **columns)
    return out.getvalue()
