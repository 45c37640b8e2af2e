"""NetCDF-4 files, which are HDF5: a reader of the parts of the format that fields are stored by, and the bytes of such files.

Read are superblocks of versions 0 to 3, object headers of versions 1 and 2, groups as symbol tables or compact links, datasets
that are contiguous, compact or chunked with a B-tree of version 1, and the filters shuffle, deflate and Fletcher-32. Checksums of
headers and chunks are verified, so damaged files are refused. Links and attributes in fractal heaps, and the chunk indexes
of layout version 4, are refused by name. Written are superblock 2, headers 2, an unlimited first dimension, chunks
of whole lines with shuffle and deflate, dimension scales, and fill values.

Chunks are read one by one: a record's lines need the chunks that hold them, and no other ones."""

from __future__ import annotations

import os
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np

# fixed values of the format: signature, undefined address, types of messages, filters
SIGNATURE, NONE = b"\x89HDF\r\n\x1a\n", (1 << 64) - 1
SPACE, LINK_INFO, TYPE, FILL, LINK, LAYOUT, GROUP, FILTERS, ATTRIBUTE, CONTINUED, SYMBOLS, ATTRIBUTE_INFO = 1, 2, 3, 5, 6, 8, 10, 11, 12, 16, 17, 21
DEFLATE, SHUFFLE, FLETCHER = 1, 2, 3
#: Children of a node of the chunk tree, as files without other settings have it.
FAN = 64
LEVEL = 4


def lookup3(data: bytes) -> int:
    """The checksum of headers: Jenkins' published hash, with start value 0."""
    mask = 0xFFFFFFFF
    rot = lambda x, k: (x << k | x >> 32 - k) & mask
    n = len(data)
    a = b = c = 0xDEADBEEF + n & mask
    if not n:
        return c
    words = struct.unpack(f"<{(n + 11) // 12 * 3}I", data + bytes(-n % 12))
    last = len(words) - 3
    for k in range(0, last, 3):
        a, b, c = a + words[k] & mask, b + words[k + 1] & mask, c + words[k + 2] & mask
        for turn in (4, 6, 8, 16, 19, 4):
            # the three parts change places after each step
            a, c = (a - c ^ rot(c, turn)) & mask, c + b & mask
            a, b, c = b, c, a
    a, b, c = a + words[last] & mask, b + words[last + 1] & mask, c + words[last + 2] & mask
    for turn in (14, 11, 25, 16, 4, 14, 24):
        c = (c ^ b) - rot(b, turn) & mask
        a, b, c = b, c, a
    return b


def fletcher(data: bytes) -> int:
    """The checksum of chunks, over big-endian words of 16 bits."""
    one = two = 0
    for x in struct.unpack(f">{(len(data) + 1) // 2}H", data + bytes(len(data) % 2)):
        one = (one + x) % 65535
        two = (two + one) % 65535
    return two << 16 | one


# -- reading --------------------------------------------------------------------------------------------------------


@dataclass
class Dataset:
    name: str
    kind: np.dtype
    shape: tuple[int, ...]
    attributes: dict
    dims: list[str] = field(default_factory=list)
    chunk: tuple[int, ...] | None = None
    at: int = NONE
    size: int = 0
    inline: bytes | None = None
    filters: list[tuple[int, tuple]] = field(default_factory=list)
    missing: bytes | None = None


class Hdf5:
    """The structure of a file, and access to its variables' records."""

    #: Bytes of values that this process has read.
    taken = 0

    def __init__(self, path: str):
        self.path, self.length = path, os.path.getsize(path)
        head = self._bytes(0, min(self.length, 96))
        if head[:8] != SIGNATURE:
            raise ValueError(f"can't read {path}: no HDF5 file")
        if len(head) < 48:
            raise ValueError(f"{path} is damaged: it ends too early")
        version = head[8]
        if version in (0, 1):
            wide, start = head[13:15], 24 + 4 * version
            base, _, end, _ = struct.unpack("<4Q", head[start : start + 32])
            root = struct.unpack("<Q", head[start + 40 : start + 48])[0]
        elif version in (2, 3):
            wide = head[9:11]
            base, _, end, root, said = struct.unpack("<4QI", head[12:48])
            if lookup3(head[:44]) != said:
                raise ValueError(f"{path} is damaged: its first block")
        else:
            raise ValueError(f"can't read {path}: superblock of version {version}")
        if wide != b"\x08\x08" or base:
            raise ValueError(f"can't read {path}: addresses that aren't of eight bytes from its start")
        if end > self.length:
            raise ValueError(f"{path} is damaged: it ends too early")
        links, self.attributes, _ = self._object(root)
        self._trees: dict[str, dict] = {}
        self.places, by_address, listed = [], {}, {}
        for name, at in links.items():
            _, attributes, messages = self._object(at)
            if LAYOUT in messages:
                listed[name] = attributes.pop("DIMENSION_LIST", None)
                for own in ("CLASS", "NAME", "REFERENCE_LIST", "_Netcdf4Dimid", "_Netcdf4Coordinates"):
                    attributes.pop(own, None)
                self.places.append(self._dataset(name, attributes, messages))
                by_address[at] = name
        sizes = {p.name: p.shape[0] for p in self.places if len(p.shape) == 1}
        for p in self.places:
            refs = listed[p.name]
            if refs and all(r in by_address for r in refs):
                p.dims = [by_address[r] for r in refs]
            elif len(p.shape) == 1 and refs is None:
                p.dims = [p.name]
            else:  # without scales: by the usual names and lengths
                p.dims = [next((d for d in usual if sizes.get(d) == n), f"phony_dim_{k}") for k, (n, usual) in enumerate(zip(p.shape, (("time",), ("y", "lat", "latitude"), ("x", "lon", "longitude")), strict=False))]
        self.dims = list({d: n for p in self.places for d, n in zip(p.dims, p.shape, strict=True)}.items())
        self.records = dict(self.dims).get("time", 0)

    def _bytes(self, at: int, n: int) -> bytes:
        if at + n > self.length:
            raise ValueError(f"{self.path} is damaged: an address beyond its end")
        with open(self.path, "rb") as f:
            f.seek(at)
            found = f.read(n)
        if len(found) < n:
            raise ValueError(f"{self.path} is damaged: it ends inside a block")
        return found

    # headers

    def _object(self, at: int) -> tuple[dict[str, int], dict, dict[int, list[bytes]]]:
        """Links, attributes and messages by type of an object."""
        messages: dict[int, list[bytes]] = {}
        for kind, data in self._messages(at):
            messages.setdefault(kind, []).append(data)
        for kind, what in ((LINK_INFO, "links"), (ATTRIBUTE_INFO, "attributes")):
            for data in messages.get(kind, []):
                skip = 2 + (8 if kind == LINK_INFO else 2) * (data[1] & 1)
                if struct.unpack("<Q", data[skip : skip + 8])[0] != NONE:
                    raise ValueError(f"can't read {self.path}: {what} in a fractal heap")
        links = dict(self._link(x) for x in messages.get(LINK, []))
        for x in messages.get(SYMBOLS, []):
            tree, heap = struct.unpack("<2Q", x[:16])
            names = self._heap(heap)
            links |= self._symbols(tree, names)
        return links, dict(self._attribute(x) for x in messages.get(ATTRIBUTE, [])), messages

    def _messages(self, at: int) -> list[tuple[int, bytes]]:
        start = self._bytes(at, 16)
        out, blocks = [], []
        if start[:4] == b"OHDR":
            flags = start[5]
            skip = 6 + (16 if flags & 32 else 0) + (4 if flags & 16 else 0)
            wide = 1 << (flags & 3)
            size = int.from_bytes(self._bytes(at + skip, wide), "little")
            blocks.append((at, skip + wide, skip + wide + size))
            ordered = bool(flags & 4)
            while blocks:
                begin, first, last = blocks.pop(0)
                data = self._bytes(begin, last + 4)
                if lookup3(data[:last]) != struct.unpack("<I", data[last:])[0]:
                    raise ValueError(f"{self.path} is damaged: a header's checksum")
                k = first
                while k + 4 + 2 * ordered <= last:
                    kind, n = data[k], int.from_bytes(data[k + 1 : k + 3], "little")
                    k += 4 + 2 * ordered
                    body = data[k : k + n]
                    k += n
                    if kind == CONTINUED:
                        to, length = struct.unpack("<2Q", body[:16])
                        if self._bytes(to, 4) != b"OCHK":
                            raise ValueError(f"{self.path} is damaged: a header's continuation")
                        blocks.append((to, 4, length - 4))
                    else:
                        out.append((kind, body))
            return out
        if start[0] != 1:
            raise ValueError(f"{self.path} is damaged: no object header at {at}")
        blocks.append((at + 16, struct.unpack("<I", start[8:12])[0]))
        while blocks:
            begin, n = blocks.pop(0)
            data, k = self._bytes(begin, n), 0
            while k + 8 <= n:
                kind, size = struct.unpack("<2H", data[k : k + 4])
                body = data[k + 8 : k + 8 + size]
                k += 8 + size
                if kind == CONTINUED:
                    blocks.append(struct.unpack("<2Q", body[:16]))
                else:
                    out.append((kind, body))
        return out

    @staticmethod
    def _link(data: bytes) -> tuple[str, int]:
        flags, k = data[1], 2
        kind = data[k] if flags & 8 else 0
        k += bool(flags & 8) + 8 * bool(flags & 4) + bool(flags & 16)
        wide = 1 << (flags & 3)
        n = int.from_bytes(data[k : k + wide], "little")
        name = data[k + wide : k + wide + n].decode()
        return name, NONE if kind else struct.unpack("<Q", data[k + wide + n : k + wide + n + 8])[0]

    def _heap(self, at: int) -> bytes:
        head = self._bytes(at, 32)
        size, _, to = struct.unpack("<3Q", head[8:])
        if head[:4] != b"HEAP":
            raise ValueError(f"{self.path} is damaged: a group's names")
        return self._bytes(to, size)

    def _symbols(self, at: int, names: bytes) -> dict[str, int]:
        head = self._bytes(at, 24)
        if head[:4] == b"SNOD":
            raw, out = self._bytes(at + 8, 40 * struct.unpack("<H", head[6:8])[0]), {}
            for k in range(0, len(raw), 40):
                name, to = struct.unpack("<2Q", raw[k : k + 16])
                out[names[name : names.index(b"\0", name)].decode()] = to
            return out
        if head[:4] != b"TREE":
            raise ValueError(f"{self.path} is damaged: a group's tree")
        n = struct.unpack("<H", head[6:8])[0]
        raw, out = self._bytes(at + 24, 16 * n + 8), {}
        for k in range(n):
            out |= self._symbols(struct.unpack("<Q", raw[16 * k + 8 : 16 * k + 16])[0], names)
        return out

    def _type(self, data: bytes) -> np.dtype | str:
        """A numpy type, or the name of what is read in another way."""
        kind, bits, size = data[0] & 15, data[1], struct.unpack("<I", data[4:8])[0]
        order = ">" if bits & 1 else "<"
        if kind == 0:
            return np.dtype(f"{order}{'i' if bits & 8 else 'u'}{size}")
        if kind == 1:
            return np.dtype(f"{order}f{size}")
        if kind == 3:
            return np.dtype(f"S{max(size, 1)}")
        return {7: "reference", 9: "list" if data[1] & 15 == 0 else "text"}.get(kind, "other")

    @staticmethod
    def _space(data: bytes) -> tuple[int, ...]:
        skip = 8 if data[0] == 1 else 4
        return struct.unpack(f"<{data[1]}Q", data[skip : skip + 8 * data[1]])

    def _attribute(self, data: bytes) -> tuple[str, object]:
        version = data[0]
        sizes, k = struct.unpack("<3H", data[2:8]), 8 + (version == 3)
        parts = []
        for n in sizes:
            parts.append(data[k : k + n])
            k += n + (-n % 8 if version == 1 else 0)
        name, kind, shape = parts[0].split(b"\0")[0].decode(), self._type(parts[1]), self._space(parts[2])
        n = int(np.prod(shape, initial=1))
        if isinstance(kind, np.dtype):
            values = np.frombuffer(data[k:], kind, n)
            return name, values[0].split(b"\0")[0].decode(errors="replace") if kind.kind == "S" else values.tolist()
        if kind in ("list", "text"):
            found = [self._global(*struct.unpack("<IQI", data[k + 16 * j : k + 16 * j + 16])) for j in range(n)]
            return name, found[0].decode(errors="replace") if kind == "text" and found else [struct.unpack("<Q", x[:8])[0] for x in found if len(x) >= 8]
        return name, None

    def _global(self, n: int, at: int, index: int) -> bytes:
        """An element of a list of any length, in the heap that all objects share."""
        if not n or at in (0, NONE):
            return b""
        head = self._bytes(at, 16)
        if head[:4] != b"GCOL":
            raise ValueError(f"{self.path} is damaged: the shared heap")
        data, k = self._bytes(at, struct.unpack("<Q", head[8:])[0]), 16
        while k + 16 <= len(data):
            own, _, _, size = struct.unpack("<2HIQ", data[k : k + 16])
            if own == index:
                return data[k + 16 : k + 16 + size]
            if not own:
                break
            k += 16 + size + -size % 8
        raise ValueError(f"{self.path} is damaged: the shared heap")

    def _dataset(self, name: str, attributes: dict, messages: dict[int, list[bytes]]) -> Dataset:
        kind, layout = self._type(messages[TYPE][0]), messages[LAYOUT][0]
        if not isinstance(kind, np.dtype):
            raise ValueError(f"can't read {self.path}: the type of {name}")
        out = Dataset(name, kind, self._space(messages[SPACE][0]), attributes)
        if layout[0] != 3 or layout[1] > 2:
            raise ValueError(f"can't read {self.path}: data layout {layout[0]} of {name}")
        if layout[1] == 0:
            out.inline = layout[4 : 4 + struct.unpack("<H", layout[2:4])[0]]
        elif layout[1] == 1:
            out.at, out.size = struct.unpack("<2Q", layout[2:18])
        else:
            rank = layout[2] - 1
            out.at = struct.unpack("<Q", layout[3:11])[0]
            out.chunk = struct.unpack(f"<{rank}I", layout[11 : 11 + 4 * rank])
        for data in messages.get(FILTERS, []):
            version, k = data[0], 8 if data[0] == 1 else 2
            for _ in range(data[1]):
                which = struct.unpack("<H", data[k : k + 2])[0]
                named = version == 1 or which >= 256
                length, _, n = struct.unpack("<3H", data[k + 2 : k + 8]) if named else (0, *struct.unpack("<2H", data[k + 2 : k + 6]))
                k += (8 if named else 6) + length + (-length % 8 if version == 1 else 0)
                out.filters.append((which, struct.unpack(f"<{n}I", data[k : k + 4 * n])))
                k += 4 * n + (4 if version == 1 and n % 2 else 0)
                if which not in (DEFLATE, SHUFFLE, FLETCHER):
                    raise ValueError(f"can't read {self.path}: filter {which} of {name}")
        for data in messages.get(FILL, []):
            if data[0] == 3 and data[1] & 32 or data[0] in (1, 2) and len(data) > 8 and data[3]:
                k = 2 if data[0] == 3 else 4
                n = struct.unpack("<I", data[k : k + 4])[0]
                out.missing = data[k + 4 : k + 4 + n] if n == kind.itemsize else None
        return out

    # values

    def place(self, name: str) -> Dataset:
        return next(p for p in self.places if p.name == name)

    def shape(self, p: Dataset) -> tuple[int, ...]:
        return p.shape

    def dim_names(self, p: Dataset) -> list[str]:
        return p.dims

    def field_name(self) -> str:
        found = next((p.name for p in self.places if len(p.shape) == 3), None)
        if found is None:
            raise ValueError(f"{self.path} has no variable over time, y and x")
        return found

    def fill(self, p: Dataset) -> float | None:
        found = p.attributes.get("_FillValue", p.attributes.get("missing_value"))
        return found[0] if isinstance(found, list) and found else None

    def _chunks(self, p: Dataset) -> dict[tuple[int, ...], tuple[int, int, int]]:
        """Address, size and filter mask of the chunks that there are, by the place of their first value."""
        if p.name not in self._trees:
            out: dict = {}
            stack = [p.at] if p.at != NONE else []
            key = 8 + 8 * (len(p.shape) + 1)
            while stack:
                at = stack.pop()
                head = self._bytes(at, 24)
                if head[:5] != b"TREE\x01":
                    raise ValueError(f"{self.path} is damaged: the chunk tree of {p.name}")
                n = struct.unpack("<H", head[6:8])[0]
                raw = self._bytes(at + 24, n * (key + 8))
                for k in range(0, len(raw), key + 8):
                    size, skipped, *first = struct.unpack(f"<2I{len(p.shape)}Q", raw[k : k + key - 8])
                    to = struct.unpack("<Q", raw[k + key : k + key + 8])[0]
                    if head[5]:
                        stack.append(to)
                    elif any(a % c or a >= n for a, c, n in zip(first, p.chunk, p.shape, strict=True)) or tuple(first) in out or skipped >> len(p.filters):
                        raise ValueError(f"{self.path} is damaged: the chunk tree of {p.name}")
                    else:
                        out[tuple(first)] = (to, size, skipped)
            self._trees[p.name] = out
        return self._trees[p.name]

    def _chunk(self, p: Dataset, first: tuple[int, ...]) -> np.ndarray:
        found = self._chunks(p).get(first)
        if found is None:
            return np.full(p.chunk, np.frombuffer(p.missing, p.kind)[0] if p.missing else 0, p.kind)
        at, size, skipped = found
        data = self._bytes(at, size)
        Hdf5.taken += size
        try:
            for k in range(len(p.filters) - 1, -1, -1):
                which, values = p.filters[k]
                if skipped >> k & 1:
                    if which == SHUFFLE:
                        raise ValueError("a filter that is never left out")
                    continue
                if which == DEFLATE:
                    data = zlib.decompress(data)
                elif which == SHUFFLE:
                    wide = values[0] if values else p.kind.itemsize
                    whole = len(data) // wide * wide
                    data = np.frombuffer(data[:whole], np.uint8).reshape(wide, -1).T.tobytes() + data[whole:]
                else:
                    if fletcher(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
                        raise ValueError("checksum")
                    data = data[:-4]
            return np.frombuffer(data, p.kind).reshape(p.chunk)
        except (zlib.error, ValueError) as error:
            raise ValueError(f"{self.path} is damaged: a chunk of {p.name} ({error})") from None

    def _box(self, p: Dataset, low: tuple[int, ...], high: tuple[int, ...]) -> np.ndarray:
        """Values from low up to high, by the chunks that hold them."""
        out = np.empty([b - a for a, b in zip(low, high, strict=True)], p.kind)
        spans = [range(a // c * c, b, c) for a, b, c in zip(low, high, p.chunk, strict=True)]
        for first in np.ndindex(*(len(s) for s in spans)):
            start = tuple(s[k] for s, k in zip(spans, first, strict=True))
            to, of = [], []
            for a, b, c, s in zip(low, high, p.chunk, start, strict=True):
                lo, hi = max(a, s), min(b, s + c)
                to.append(slice(lo - a, hi - a))
                of.append(slice(lo - s, hi - s))
            out[tuple(to)] = self._chunk(p, start)[tuple(of)]
        return out

    def read(self, name: str, first: int = 0, last: int | None = None) -> np.ndarray:
        """The variable's data, or its first dimension's positions first to last alone."""
        p = self.place(name)
        last = (p.shape[0] if p.shape else 0) if last is None else min(last, p.shape[0])
        if p.chunk:
            return self._box(p, (first, *(0,) * (len(p.shape) - 1)), (last, *p.shape[1:]))
        each = int(np.prod(p.shape[1:], initial=1))
        n = (last - first) * each if p.shape else 1
        if p.inline is not None:
            found = np.frombuffer(p.inline, p.kind)[first * each : first * each + n]
        elif p.at == NONE:
            found = np.full(n, np.frombuffer(p.missing, p.kind)[0] if p.missing else 0, p.kind)
        else:
            found = np.frombuffer(self._bytes(p.at + first * each * p.kind.itemsize, n * p.kind.itemsize), p.kind)
            Hdf5.taken += found.nbytes
        return found.reshape((last - first, *p.shape[1:])) if p.shape else found.reshape(())

    def lines(self, name: str, record: int, first: int, last: int) -> np.ndarray:
        """Lines first to last of one record of a variable over (time, y, x)."""
        p = self.place(name)
        if p.chunk:
            return self._box(p, (record, first, 0), (record + 1, last, p.shape[2]))[0]
        return self.read(name, record, record + 1)[0, first:last]


# -- the bytes of a file --------------------------------------------------------------------------------------------


def packed(values: np.ndarray, level: int = LEVEL) -> bytes:
    """A chunk's bytes: those of equal weight side by side, deflated."""
    raw = np.ascontiguousarray(values)
    return zlib.compress(np.frombuffer(raw.tobytes(), np.uint8).reshape(-1, raw.itemsize).T.tobytes(), level)


def _message(kind: int, data: bytes) -> bytes:
    return struct.pack("<BHB", kind, len(data), 0) + data


def _header(messages: list[bytes]) -> bytes:
    body = b"".join(messages)
    out = b"OHDR\x02\x02" + struct.pack("<I", len(body)) + body
    return out + struct.pack("<I", lookup3(out))


def _type_of(kind: np.dtype) -> bytes:
    size = kind.itemsize
    if kind.kind == "S":
        return struct.pack("<B3BI", 0x13, 0x10, 0, 0, size)
    if kind.kind in "iu":
        return struct.pack("<B3BI2H", 0x10, 8 if kind.kind == "i" else 0, 0, 0, size, 0, 8 * size)
    exponent, bias = (8, 127) if size == 4 else (11, 1023)
    return struct.pack("<B3BI2H4BI", 0x11, 0x20, 8 * size - 1, 0, size, 0, 8 * size, 8 * size - 1 - exponent, exponent, 0, 8 * size - 1 - exponent, bias)


def _space_of(shape: tuple[int, ...], most: tuple[int, ...] | None = None) -> bytes:
    return struct.pack(f"<4B{len(shape)}Q", 2, len(shape), 1 if most else 0, 1 if shape else 0, *shape) + (struct.pack(f"<{len(most)}Q", *most) if most else b"")


def _attribute_of(name: str, value: object, kind: bytes | None = None, shape: tuple[int, ...] | None = None) -> bytes:
    """An attribute message; kind and shape where value is its bytes already."""
    if kind is None:
        if isinstance(value, str):
            raw = value.encode() + b"\0"
            kind, shape, value = _type_of(np.dtype(f"S{len(raw)}")), (), raw
        else:
            array = np.atleast_1d(np.asarray(value))
            array = array.astype(array.dtype.newbyteorder("<"))
            kind, shape, value = _type_of(array.dtype), array.shape, array.tobytes()
    space, label = _space_of(shape), name.encode() + b"\0"
    return _message(ATTRIBUTE, struct.pack("<2B3HB", 3, 0, len(label), len(kind), len(space), 1) + label + kind + space + value)


def _tree(chunks: list[tuple[tuple[int, ...], int, int]], at: int, rank: int, end: tuple[int, ...]) -> tuple[bytes, int]:
    """The nodes of a chunk tree that begins at an address, and the address of its root: chunks are (first value, address, size) in order."""
    key = lambda first, size: struct.pack(f"<2I{rank + 1}Q", size, 0, *first, 0)
    whole = 24 + (FAN + 1) * (8 + 8 * (rank + 1)) + FAN * 8
    level, nodes, out = 0, [(first, size, to) for first, to, size in chunks], []
    while True:
        groups = [nodes[k : k + FAN] for k in range(0, len(nodes), FAN)] or [[]]
        places = [at + whole * (len(out) + k) for k in range(len(groups))]
        for k, own in enumerate(groups):
            last = key(groups[k + 1][0][0], groups[k + 1][0][1]) if k + 1 < len(groups) else key(end, 0)
            raw = b"TREE" + struct.pack("<2BH2Q", 1, level, len(own), places[k - 1] if k else NONE, places[k + 1] if k + 1 < len(groups) else NONE)
            raw += b"".join(key(first, size) + struct.pack("<Q", to) for first, size, to in own) + last
            out.append(raw + bytes(whole - len(raw)))
        if len(groups) == 1:
            return b"".join(out), places[0]
        nodes = [(own[0][0], own[0][1], place) for own, place in zip(groups, places, strict=True)]
        level += 1


@dataclass
class Variable:
    """A variable to be written. chunk: of chunked ones; data: its values, or None where its chunks' sizes are given, in order."""

    name: str
    dims: tuple[str, ...]
    kind: np.dtype
    attributes: dict
    data: np.ndarray | None = None
    chunk: tuple[int, ...] | None = None
    sizes: list[int] | None = None


def layout(dims: dict[str, int | None], records: int, variables: list[Variable], attributes: dict) -> tuple[bytes, dict[str, list[int]], int]:
    """The file's bytes but for the chunks of variables without data, the addresses of these, and the file's length.

    A dimension of None is unlimited and has `records`. Every dimension has a variable of its name."""
    shape = {v.name: tuple(records if dims[d] is None else dims[d] for d in v.dims) for v in variables}
    grid = lambda v: [range(0, n, c) for n, c in zip(shape[v.name], v.chunk, strict=True)]
    chunked: dict[str, list[bytes]] = {}
    for v in variables:
        if v.chunk and v.data is not None:
            chunked[v.name] = []
            for first in np.ndindex(*(len(s) for s in grid(v))):
                own = np.full(v.chunk, v.attributes.get("_FillValue", [0])[0], v.kind)
                box = v.data[tuple(slice(s[k], s[k] + c) for s, k, c in zip(grid(v), first, v.chunk, strict=True))]
                own[tuple(slice(0, n) for n in box.shape)] = box
                chunked[v.name].append(packed(own))
    address = {v.name: 0 for v in variables}
    chunks: dict[str, list[int]] = {}
    out, end, root, heap = b"", 0, 0, 0
    # addresses don't change lengths, so the second round finds all of them in their places
    for _ in range(2):
        parts, at = [], 48

        def add(data: bytes) -> int:
            nonlocal at
            place = at
            parts.append(data + bytes(-len(data) % 8))
            at += len(parts[-1])
            return place

        objects = [_message(LINK_INFO, struct.pack("<2B2Q", 0, 0, NONE, NONE)), _message(GROUP, b"\0\0")]
        for v in variables:
            name = v.name.encode()
            objects.append(_message(LINK, struct.pack("<3B", 1, 0, len(name)) + name + struct.pack("<Q", address[v.name])))
        root = add(_header(objects + [_attribute_of(k, x) for k, x in attributes.items()]))
        # the heap holds, for each variable and dimension, the address of the dimension's own variable
        refs = [(v.name, d) for v in variables for d in v.dims if v.dims != (v.name,)]
        body = b"".join(struct.pack("<2HIQQ", k + 1, 1, 0, 8, address[d]) for k, (_, d) in enumerate(refs))
        size = max(4096, 16 + len(body) + 16)
        heap = add(b"GCOL\x01\0\0\0" + struct.pack("<Q", size) + body + struct.pack("<2HIQ", 0, 0, 0, size - 16 - len(body)) + bytes(size - 32 - len(body)))
        later = []
        for v in variables:
            most = tuple(NONE if dims[d] is None else dims[d] for d in v.dims)
            fill = v.attributes.get("_FillValue")
            messages = [_message(SPACE, _space_of(shape[v.name], most)), _message(TYPE, _type_of(v.kind))]
            messages.append(_message(FILL, struct.pack("<2B", 3, 10) if fill is None else struct.pack("<2BI", 3, 10 | 32, v.kind.itemsize) + np.asarray(fill, v.kind).tobytes()))
            if v.chunk:
                first = [tuple(s[k] for s, k in zip(grid(v), k_, strict=True)) for k_ in np.ndindex(*(len(s) for s in grid(v)))]
                sizes = [len(x) for x in chunked[v.name]] if v.data is not None else v.sizes
                known = chunks.get(v.name) or [0] * len(first)
                raw, top = _tree(list(zip(first, known, sizes, strict=True)), at, len(v.dims), shape[v.name])
                add(raw)
                messages.append(_message(LAYOUT, struct.pack(f"<3BQ{len(v.chunk)}II", 3, 2, len(v.chunk) + 1, top, *v.chunk, v.kind.itemsize)))
                messages.append(_message(FILTERS, struct.pack("<2B3HI3HI", 2, 2, SHUFFLE, 0, 1, v.kind.itemsize, DEFLATE, 0, 1, LEVEL)))
                later.append((v.name, sizes))
            else:
                raw = v.data.astype(v.kind).tobytes()
                messages.append(_message(LAYOUT, struct.pack("<2B2Q", 3, 1, add(raw), len(raw))))
            if v.dims == (v.name,):
                own = {"CLASS": "DIMENSION_SCALE", "NAME": v.name, "_Netcdf4Dimid": np.array([list(dims).index(v.name)], "<i4")}
                messages += [_attribute_of(k, x) for k, x in own.items()]
            else:
                listed = b"".join(struct.pack("<IQI", 1, heap, refs.index((v.name, d)) + 1) for d in v.dims)
                of = struct.pack("<B3BI", 0x19, 0, 0, 0, 16) + struct.pack("<B3BI", 0x17, 0, 0, 0, 8)
                messages.append(_attribute_of("DIMENSION_LIST", listed, of, (len(v.dims),)))
            messages += [_attribute_of(k, x) for k, x in v.attributes.items()]
            address[v.name] = add(_header(messages))
        open_at = at
        for name, sizes in [x for x in later if x[0] in chunked] + [x for x in later if x[0] not in chunked]:
            chunks[name] = []
            for k, n in enumerate(sizes):
                chunks[name].append(at)
                if name in chunked:
                    parts.append(chunked[name][k])
                    open_at = at + n
                at += n
        end = at
        out = b"".join(parts)
    head = SIGNATURE + struct.pack("<4B4Q", 2, 8, 8, 0, 0, NONE, end, root)
    whole = head + struct.pack("<I", lookup3(head)) + out
    assert len(whole) == open_at
    return whole, {v.name: chunks[v.name] for v in variables if v.chunk and v.data is None}, end
