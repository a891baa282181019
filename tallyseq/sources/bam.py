"""Binary alignment files (BAM) as a data source that plans by compressed blocks.

    spark.dataSource.register(bam.BamSource)
    rows = spark.read.format("bam").load(path)              # a file, or a folder that `write` made
    rows.write.format("bam").option("references", "r1:1000,r2:500").mode("append").save(folder)

A file is a run of small gzip members, each of which says how long it is, so tasks begin at block offsets.
With an index beside the file, filters on the reference, on start and end, and on mapped reads become byte
ranges: bins that may overlap the region, no earlier than its linear window allows. Ranges are cut at offsets
of the index, or else at any block, where the first record is found by checking that a chain of records
after it holds together. Rows are decoded by Arrow batch; Spark evaluates all filters again.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceArrowWriter, InputPartition, WriterCommitMessage
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual, Not

#: Bytes of a block's content, and of a task's share of a file.
PAYLOAD, SPLIT = 65_280, 32 << 20
#: Rows of a batch.
ROWS = 32_768
#: Fixed values of the format: the empty block that ends a file, letters of operations and bases, which
#: operations take up the reference, size of a linear window, first bin of each level.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
OPERATIONS, BASES, ON_REFERENCE = "MIDNSHP=X", "=ACMGRSVTWYHKDBN", (0, 2, 3, 7, 8)
WINDOW = 14
LEVELS = ((0, 29), (1, 26), (9, 23), (73, 20), (585, 17), (4681, 14))
#: Fixed values of the format: a record's head.
HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("l_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_cigar", "<u2"), ("flag", "<u2"), ("l_seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("tlen", "<i4")])
BASIC = "read_id string, ref_id string, s long, e long, mapq int, flag int, is_unmapped boolean, is_reverse boolean, is_secondary boolean, is_supplementary boolean, score int, mismatches int"
FULL = BASIC + ", cigar string, sequence string, quality string"


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


# ---- blocks


def pack_block(payload: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(payload) + z.flush()
    return bytes.fromhex("1f8b08040000000000ff060042430200") + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(payload), len(payload))


def block_size(data: bytes, at: int) -> int:
    """Bytes of the block at `at`, 0 if none begins there."""
    if len(data) < at + 18 or data[at: at + 4] != b"\x1f\x8b\x08\x04":
        return 0
    extra, = struct.unpack_from("<H", data, at + 10)
    i, end = at + 12, at + 12 + extra
    while i + 4 <= min(end, len(data) - 2):
        size, = struct.unpack_from("<H", data, i + 2)
        if data[i: i + 2] == b"BC" and size == 2:
            return struct.unpack_from("<H", data, i + 4)[0] + 1
        i += 4 + size
    return 0


def opened(path: str):
    """A seekable file of any file system that the path's scheme names, and its size."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return store.open_input_file(name), store.get_file_info(name).size


def blocks(path: str, at: int, guess: bool = False, step: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of blocks from `at` on; with guess, from the first one that begins there or after."""
    file, size = opened(path)
    with file:
        file.seek(at)
        data, start = b"", at
        while start + len(data) < size or data:
            if len(data) < (1 << 16) + 64 and start + len(data) < size:
                data += file.read(step)
            if guess:
                i = data.find(b"\x1f\x8b\x08\x04")
                while i >= 0:  # a block is one if another follows it, or the file's end
                    n = block_size(data, i)
                    if n and (start + i + n == size or block_size(data, i + n)):
                        break
                    i = data.find(b"\x1f\x8b\x08\x04", i + 1)
                if i < 0:
                    if start + len(data) >= size:
                        return
                    start, data = start + max(0, len(data) - (1 << 16)), data[-(1 << 16):] + file.read(step)
                    continue
                data, start, guess = data[i:], start + i, False
            n = block_size(data, 0)
            if not n or n > len(data):
                raise ValueError(f"{path}: no whole block at {start}")
            yield start, zlib.decompress(data[18 if data[10:12] == b"\x06\x00" else 12 + struct.unpack_from("<H", data, 10)[0]: n - 8], -15)
            data, start = data[n:], start + n


# ---- header and records


@dataclass
class Header:
    names: list[str]
    lengths: list[int]
    first: int  # virtual offset of the first record
    packed: bytes = b""  # the header's own blocks, if the first record begins a block

    @classmethod
    def read(cls, path: str, like: Header | None = None) -> Header:
        """A file's header; it isn't parsed if the file begins with the very blocks of the header `like`."""
        if like is not None and like.packed:
            file, size = opened(path)
            with file:
                if size > len(like.packed) + len(END) and file.read(len(like.packed)) == like.packed:
                    return like
        data, ends, state = bytearray(), [], cls([], [], -1)
        at, left = 0, -1  # where the next reference begins, and how many are to come
        for block, payload in blocks(path, 0):
            ends.append((len(data), block))
            data += payload
            at, left = state._parse(data, at, left)
            if left == 0 and at < len(data):
                start, block = max(x for x in ends if x[0] <= at)
                state.first = block << 16 | at - start
                if at == start:
                    file, _ = opened(path)
                    with file:
                        state.packed = file.read(block)
                return state
        if left:
            raise ValueError(f"{path}: no alignment header")
        return state

    def _parse(self, data: bytearray, at: int, left: int) -> tuple[int, int]:
        """Take the references that data holds whole from `at` on; -1 are left before their number is known."""
        if left < 0:
            if len(data) < 12:
                return at, left
            if data[:4] != b"BAM\x01":
                raise ValueError("not a binary alignment file")
            at = 8 + struct.unpack_from("<i", data, 4)[0]
            if len(data) < at + 4:
                return 0, -1
            left, at = struct.unpack_from("<i", data, at)[0], at + 4
        while left and len(data) >= at + 4 and len(data) >= at + 8 + (size := struct.unpack_from("<i", data, at)[0]):
            self.names.append(data[at + 4: at + 3 + size].decode())
            self.lengths.append(struct.unpack_from("<i", data, at + 4 + size)[0])
            at, left = at + 8 + size, left - 1
        return at, left


def packed_header(references: list[tuple[str, int]]) -> bytes:
    text = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{n}\tLN:{k}\n" for n, k in references)
    out = b"BAM\x01" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(references))
    return out + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", k) for n, k in references)


def bin_of(start: int, end: int) -> int:
    """The smallest bin that holds [start, end)."""
    for first, bits in LEVELS[::-1]:
        if start >> bits == (max(end, start + 1) - 1) >> bits:
            return first + (start >> bits)
    return 0


def bins_over(start: int, end: int) -> set[int]:
    """All bins that overlap [start, end)."""
    return {b for first, bits in LEVELS for b in range(first + (start >> bits), first + ((end - 1) >> bits) + 1)}


def cigar_numbers(cigar: str | None) -> list[int]:
    out, n = [], 0
    for c in cigar or "":
        if c.isdigit():
            n = 10 * n + int(c)
        elif c in OPERATIONS:
            out.append(n << 4 | OPERATIONS.index(c))
            n = 0
    return out


def packed_record(name, flag, ref, pos, mapq, cigar, sequence, quality, score, mismatches) -> tuple[bytes, int]:
    """A record and the end of its alignment; ref is the reference's number, -1 without one."""
    ops = cigar_numbers(cigar)
    end = pos + sum(x >> 4 for x in ops if x & 15 in ON_REFERENCE)
    seq = sequence or ""
    codes = [max(0, BASES.find(c)) if c in BASES else 15 for c in seq.upper()] + [0] * (len(seq) % 2)
    tags = b"".join(t + b"i" + struct.pack("<i", v) for t, v in ((b"AS", score), (b"NM", mismatches)) if v is not None)
    body = (name or "*").encode() + b"\0" + struct.pack(f"<{len(ops)}I", *ops) + bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(codes), 2))
    body += bytes(ord(c) - 33 for c in quality) if quality and len(quality) == len(seq) else b"\xff" * len(seq)
    head = struct.pack("<iiBBHHHiiii", ref, pos, len((name or "*").encode()) + 1, mapq, bin_of(max(pos, 0), max(end, 1)), len(ops), flag, len(seq), -1, -1, 0)
    return struct.pack("<i", len(head) + len(body) + len(tags)) + head + body + tags, max(end, pos + 1)


def is_record(data: bytes, at: int, lengths: list[int]) -> int:
    """Bytes of what could be a record at `at`; 0 if it is none, -1 if data ends before it can be told."""
    if len(data) < at + 36:
        return -1
    size, ref, pos, l_name, _, _, n_cigar, _, l_seq, next_ref, next_pos, _ = struct.unpack_from("<iiiBBHHHiiii", data, at)
    ok = -1 <= ref < len(lengths) and -1 <= next_ref < len(lengths) and -1 <= pos and -1 <= next_pos and l_name > 0 and l_seq >= 0
    if not ok or pos > (lengths[ref] if ref >= 0 else 1 << 31) or size < 32 + l_name + 4 * n_cigar + (l_seq + 1) // 2 + l_seq or size > 1 << 28:
        return 0
    name = data[at + 36: at + 36 + l_name]
    if len(name) < l_name:
        return -1
    return size + 4 if name[-1] == 0 and all(33 <= c <= 126 for c in name[:-1]) else 0


def first_record(data: bytes, lengths: list[int], chain: int = 20) -> int | None:
    """Where the first record begins in data that begins inside one, perhaps: `chain` records follow each
    other there, or as many as there are."""
    for at in range(len(data)):
        i, n = at, 0
        while n < chain and (size := is_record(data, i, lengths)) > 0:
            i, n = i + size, n + 1
        if n == chain or (n and (size < 0 or i == len(data))):
            return at
    return None


def records(path: str, part: Part, lengths: list[int]) -> Iterator[tuple[bytes, np.ndarray]]:
    """(content, starts) of runs of records that begin in a part of a file."""
    data, marks, starts, at, sure = bytearray(), [], [], part.begin & 0xFFFF if part.exact else 0, part.exact
    source = blocks(path, part.begin >> 16, guess=not part.exact)

    def more() -> bool:
        found = next(source, None)
        if found is None:
            return False
        marks.append((len(data), found[0]))
        data.extend(found[1])
        return True

    def place(i: int) -> int:
        """The virtual offset of a position."""
        start, block = next(m for m in reversed(marks) if m[0] <= i)
        return block << 16 | i - start

    if not more() or marks[0][1] << 16 >= part.end:
        return
    if not sure:
        while len(data) < 4 * PAYLOAD and more():
            pass
        found = first_record(bytes(data), lengths)
        if found is None:
            return
        at = found
    while True:
        while len(data) < at + 4 and more():
            pass
        if len(data) < at + 4 or place(at) >= part.end:
            break
        size = 4 + struct.unpack_from("<i", data, at)[0]
        while len(data) < at + size and more():
            pass
        if len(data) < at + size:
            raise ValueError(f"{path}: a record is cut off")
        starts.append(at)
        at += size
        if len(starts) == ROWS or at > 16 << 20:
            yield bytes(data[:at]), np.array(starts)
            keep = [m for m in marks if m[0] <= at][-1:] + [m for m in marks if m[0] > at]
            marks[:] = [(m[0] - at, m[1]) for m in keep]
            del data[:at]
            starts, at = [], 0
    if starts:
        yield bytes(data[:at]), np.array(starts)


def tags(data: bytes, at: int, end: int) -> dict[bytes, int]:
    """Whole-number tags of a record."""
    sizes, out = {65: 1, 99: 1, 67: 1, 115: 2, 83: 2, 105: 4, 73: 4, 102: 4}, {}
    kinds = {99: "<b", 67: "<B", 115: "<h", 83: "<H", 105: "<i", 73: "<I"}
    while at + 3 <= end:
        kind = data[at + 2]
        if kind in (90, 72):  # text
            size = data.index(0, at + 3) - at - 2
        elif kind == 66:  # array
            size = 5 + sizes[data[at + 3]] * struct.unpack_from("<i", data, at + 4)[0]
        else:
            size = sizes[kind]
            if kind in kinds:
                out[data[at: at + 2]] = struct.unpack_from(kinds[kind], data, at + 3)[0]
        at += 3 + size
    return out


def decode(data: bytes, starts: np.ndarray, names: list[str], full: bool):
    """A batch of records."""
    import pyarrow as pa

    raw = np.frombuffer(data, np.uint8)
    h = raw[starts[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD)[:, 0]
    strings = lambda bytes_, sizes: pa.StringArray.from_buffers(len(sizes), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(bytes_)))
    l_name, n_cigar, l_seq = (h[c].astype(np.int64) for c in ("l_name", "n_cigar", "l_seq"))
    at = starts + 36
    name = strings(raw[spread(at, l_name - 1)], l_name - 1)
    at = at + l_name
    ops = raw[spread(at, 4 * n_cigar)].view("<u4").astype(np.int64)
    long = np.where(np.isin(ops & 15, ON_REFERENCE), ops >> 4, 0)
    upto = np.concatenate([[0], np.cumsum(long)])
    edge = np.concatenate([[0], np.cumsum(n_cigar)])
    s = h["pos"].astype(np.int64)
    ref = pa.DictionaryArray.from_arrays(pa.array(h["ref"], mask=h["ref"] < 0), pa.array(names or [""])).cast(pa.string())
    at, ends = at + 4 * n_cigar, starts + 4 + h["size"]
    found = [tags(data, a, e) for a, e in zip((at + (l_seq + 1) // 2 + l_seq).tolist(), ends.tolist())]
    flag = h["flag"].astype(np.int32)
    cols = [name, ref, pa.array(s), pa.array(s + upto[edge[1:]] - upto[edge[:-1]]), pa.array(h["mapq"].astype(np.int32)), pa.array(flag)]
    cols += [pa.array(flag & bit != 0) for bit in (0x4, 0x10, 0x100, 0x800)] + [pa.array([t.get(k) for t in found], pa.int32()) for k in (b"AS", b"NM")]
    fields = ["read_id", "ref_id", "s", "e", "mapq", "flag", "is_unmapped", "is_reverse", "is_secondary", "is_supplementary", "score", "mismatches"]
    if full:
        cigars = [f"{x >> 4}{OPERATIONS[x & 15]}" for x in ops.tolist()]
        cols.append(pa.array(["".join(cigars[a:b]) or "*" for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]))
        packed = raw[spread(at, (l_seq + 1) // 2)]
        both = np.frombuffer(BASES.encode(), np.uint8)[np.stack([packed >> 4, packed & 15], axis=1).ravel()]
        cols.append(strings(both[spread(np.concatenate([[0], np.cumsum((l_seq + 1) // 2 * 2)])[:-1], l_seq)], l_seq))
        at = at + (l_seq + 1) // 2
        known = (l_seq > 0) & (raw[np.where(l_seq > 0, at, 0)] != 255)
        l_qual = np.where(known, l_seq, 0)
        quality = strings(raw[spread(at, l_qual)] + 33, l_qual)
        cols.append(pa.array([q if k else None for q, k in zip(quality.to_pylist(), known.tolist())], pa.string()))
        fields += ["cigar", "sequence", "quality"]
    return pa.RecordBatch.from_arrays(cols, fields)


# ---- index


class Index:
    """Bins and linear windows of a file (BAI): bins[ref][bin] is a list of (begin, end), linear[ref] a list of
    offsets; all offsets are virtual, of blocks in the upper bits and of content in the lower sixteen. Only
    references with records are held, as a file of a folder has few of all `n`."""

    def __init__(self, n: int):
        self.n = n
        self.bins: dict[int, dict[int, list[list[int]]]] = {}
        self.linear: dict[int, list[int]] = {}
        self.no_place = 0

    def add(self, ref: int, start: int, end: int, begin: int, after: int) -> None:
        if ref < 0:
            self.no_place += 1
            return
        chunks = self.bins.setdefault(ref, {}).setdefault(bin_of(start, end), [])
        if chunks and chunks[-1][1] >> 16 == begin >> 16:
            chunks[-1][1] = after
        else:
            chunks.append([begin, after])
        windows = self.linear.setdefault(ref, [])
        for w in range(start >> WINDOW, (end - 1 >> WINDOW) + 1):
            windows.extend([0] * (w + 1 - len(windows)))
            windows[w] = windows[w] or begin

    def pack(self) -> bytes:
        out, upto = [b"BAI\x01" + struct.pack("<i", self.n)], 0
        for ref in sorted(self.bins.keys() | self.linear.keys()):
            bins, windows = self.bins.get(ref, {}), self.linear.get(ref, [])
            out += [bytes(8 * (ref - upto)), struct.pack("<i", len(bins))]  # two zeros for each without records
            for b, chunks in bins.items():
                out += [struct.pack("<Ii", b, len(chunks)), *(struct.pack("<QQ", *c) for c in chunks)]
            out.append(struct.pack("<i", len(windows)) + struct.pack(f"<{len(windows)}Q", *windows))
            upto = ref + 1
        return b"".join([*out, bytes(8 * (self.n - upto)), struct.pack("<Q", self.no_place)])

    @classmethod
    def read(cls, path: str) -> Index | None:
        """The index beside a file, None if there is none."""
        try:
            file, _ = opened(path + ".bai")
        except (FileNotFoundError, OSError):
            return None
        with file:
            data = file.read()
        out, at, ref, none = cls(struct.unpack_from("<i", data, 4)[0]), 8, 0, bytes(8)
        while ref < out.n:
            if data[at: at + 8] == none:
                at, ref = at + 8, ref + 1
                continue
            n, at = struct.unpack_from("<i", data, at)[0], at + 4
            for _ in range(n):
                (b, k), at = struct.unpack_from("<Ii", data, at), at + 8
                if b < 37_450:  # the last one holds counts, not places
                    out.bins.setdefault(ref, {})[b] = [list(struct.unpack_from("<QQ", data, at + 16 * i)) for i in range(k)]
                at += 16 * k
            n, at = struct.unpack_from("<i", data, at)[0], at + 4
            if n:
                out.linear[ref] = list(struct.unpack_from(f"<{n}Q", data, at))
            at, ref = at + 8 * n, ref + 1
        return out

    def chunks(self, ref: int, start: int, end: int) -> list[tuple[int, int]]:
        """Disjoint ranges that hold all records of a reference that overlap [start, end)."""
        windows = self.linear.get(ref, [])
        least = next((x for x in windows[start >> WINDOW:] if x), None) if start >> WINDOW < len(windows) else None
        if start >> WINDOW < len(windows) and windows[start >> WINDOW]:
            least = windows[start >> WINDOW]
        out: list[list[int]] = []
        wanted = bins_over(start, min(end, 1 << 29))
        for begin, after in sorted(tuple(c) for b, own in self.bins.get(ref, {}).items() if b in wanted for c in own if least is None or c[1] > least):
            begin = max(begin, least or 0)
            if out and begin >> 16 <= out[-1][1] >> 16:
                out[-1][1] = max(out[-1][1], after)
            else:
                out.append([begin, after])
        return [tuple(c) for c in out]

    def places(self) -> list[int]:
        """Offsets at which records begin, in order."""
        return sorted({c[0] for bins in self.bins.values() for own in bins.values() for c in own} | {x for w in self.linear.values() for x in w if x})

    def last(self) -> int:
        """Where records without a place begin."""
        return max((c[1] for bins in self.bins.values() for own in bins.values() for c in own), default=0)


# ---- the source


@dataclass
class Part(InputPartition):
    """Records of a file that begin at or after `begin` and before `end` (virtual offsets). exact: one begins
    at `begin`; else the first block at or after it is searched for one."""

    path: str
    begin: int
    end: int
    exact: bool


def cut(path: str, begin: int, end: int, exact: bool, places: list[int], size: int) -> list[Part]:
    """Parts of about `size` compressed bytes: at known places where there are any, else at block borders."""
    out = []
    while (end >> 16) - (begin >> 16) > size + size // 2:
        goal = begin + (size << 16)
        at = next((p for p in places if goal <= p < end), None)
        here, known = (at, True) if at is not None and (at - goal) >> 16 <= size else (goal >> 16 << 16, False)
        out.append(Part(path, begin, here, exact))
        begin, exact = here, known
    return [*out, Part(path, begin, end, exact)]


def files_of(path: str) -> list[str]:
    """A file itself, or those that the lists of a folder name; without lists, all of its alignment files."""
    from pyarrow import fs

    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    store, name = fs.FileSystem.from_uri(uri)
    if store.get_file_info(name).type == fs.FileType.File:
        return [uri]
    found = sorted(x.base_name for x in store.get_file_info(fs.FileSelector(name)) if x.is_file)
    listed = [x for x in found if x.startswith("_files-")]
    if listed:
        found = [line for x in listed for line in store.open_input_file(f"{name}/{x}").read().decode().split()]
    return [f"{uri.rstrip('/')}/{x}" for x in sorted(found) if x.endswith(".bam")]


class BamReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size, self.full = options["path"], int(options.get("splitBytes", SPLIT)), options.get("sequences", "false").lower() == "true"
        self.refs: set[str] | None = None
        self.start, self.end, self.mapped = 0, 1 << 29, None

    def pushFilters(self, filters):
        """Takes what prunes blocks; every filter stays with Spark as well, as blocks hold other records too."""
        for f in filters:
            column = getattr(f, "attribute", getattr(getattr(f, "child", None), "attribute", None))
            if isinstance(f, (EqualTo, In)) and column == ("ref_id",):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.refs = own if self.refs is None else self.refs & own
            elif isinstance(f, (LessThan, LessThanOrEqual)) and column == ("s",):
                self.end = min(self.end, f.value + isinstance(f, LessThanOrEqual))
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)) and column in (("e",), ("s",)):
                self.start = max(self.start, f.value)  # what ends or begins later overlaps this or a later base
            elif column == ("is_unmapped",) and isinstance(f, EqualTo):
                self.mapped = not f.value
            elif column == ("is_unmapped",) and isinstance(f, Not) and isinstance(f.child, EqualTo):
                self.mapped = bool(f.child.value)
            yield f

    def partitions(self) -> list[Part]:
        out, header = [], None
        for path in files_of(self.path):
            header, index = Header.read(path, header), Index.read(path)  # files of one write have one header
            file, size = opened(path)
            file.close()
            if header.first < 0:
                continue
            whole = size << 16
            if index is None:
                out += cut(path, header.first, whole, True, [], self.size)
                continue
            places = index.places()
            narrow = self.refs is not None or self.start > 0 or self.end < 1 << 29
            if narrow and self.start < self.end:
                refs = [i for i in sorted(index.bins) if self.refs is None or header.names[i] in self.refs]
                # a read without bases on the reference counts as one base long, hence one base more
                chunks = sorted(c for i in refs for c in index.chunks(i, max(0, self.start - 1), self.end))
            else:
                chunks = [] if narrow else [(header.first, index.last() or header.first)]
            for begin, end in chunks:
                out += cut(path, begin, end, True, places, self.size)
            if not narrow and self.mapped is not True:
                out += cut(path, index.last() or header.first, whole, True, [], self.size)
        return out or [Part("", 0, 0, True)]

    def read(self, part: Part):
        if not part.path:
            return
        header = Header.read(part.path)
        for data, starts in records(part.path, part, header.lengths):
            yield decode(data, starts, header.names, self.full)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class BamWriter(DataSourceArrowWriter):
    """A file and its index for each task; a task's rows must be sorted by reference and start, reads without
    a place last. Files that no commit names are left out by readers."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.references = [(n, int(k)) for n, k in (x.rsplit(":", 1) for x in options["references"].split(",") if x)]

    def write(self, iterator) -> Written:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")
        name = f"part-{uuid.uuid4().hex}.bam"
        number = {n: i for i, (n, _) in enumerate(self.references)}
        store.create_dir(top, recursive=True)
        index, payload, at, last = Index(len(number)), bytearray(), 0, (0, -1)
        with store.open_output_stream(f"{top}/{name}") as out:
            def flush() -> None:
                nonlocal at
                while payload:
                    block = pack_block(bytes(payload[:PAYLOAD]))
                    out.write(block)
                    at += len(block)
                    del payload[:PAYLOAD]

            payload += packed_header(self.references)
            flush()
            waiting: list[tuple[int, int, int, int]] = []
            for batch in iterator:
                for r in batch.to_pylist():
                    ref = number.get(r["ref_id"], -1)
                    pos = -1 if r["s"] is None or ref < 0 else r["s"]
                    if (here := (ref if ref >= 0 else 1 << 31, pos)) < last:
                        raise ValueError("rows aren't sorted by reference and start")
                    last = here
                    record, end = packed_record(r["read_id"], r["flag"] or 0, ref, pos, r["mapq"] or 0, r.get("cigar"), r.get("sequence"), r.get("quality"), r.get("score"), r.get("mismatches"))
                    if payload and len(payload) + len(record) > PAYLOAD:
                        flush()
                        waiting = self._place(index, waiting, at << 16)
                    begin = at << 16 | len(payload)
                    payload += record
                    if len(payload) > PAYLOAD:  # one record of several blocks
                        flush()
                        index.add(ref, max(pos, 0), max(end, 1), begin, at << 16)
                    else:
                        waiting.append((ref, max(pos, 0), max(end, 1), begin))
            flush()
            self._place(index, waiting, at << 16)
            out.write(END)
        with store.open_output_stream(f"{top}/{name}.bai") as out:
            out.write(index.pack())
        return Written([name])

    @staticmethod
    def _place(index: Index, waiting: list[tuple[int, int, int, int]], end: int) -> list:
        """Index records of a block that is written: each ends where the next begins, the last at the block's end."""
        for (ref, s, e, begin), after in zip(waiting, [w[3] for w in waiting[1:]] + [end]):
            index.add(ref, s, e, begin, after)
        return []

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")
        store.create_dir(top, recursive=True)
        with store.open_output_stream(f"{top}/_files-{uuid.uuid4().hex}") as out:
            out.write("\n".join(f for m in messages if m for f in m.files).encode())


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return FULL if self.options.get("sequences", "false").lower() == "true" else BASIC

    def reader(self, schema) -> BamReader:
        return BamReader(dict(self.options))

    def writer(self, schema, overwrite) -> BamWriter:
        return BamWriter(dict(self.options))


def read_bam(spark, path: str, sequences: bool = False, split_bytes: int = SPLIT):
    """Alignments of a binary file or folder; with `sequences`, also cigar, sequence and quality.

    s and e are a half-open interval, e = s for reads without bases on the reference; reads without a place
    have a null reference and s = -1. score and mismatches are the tags AS and NM, or null.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)
    return spark.read.format("bam").option("sequences", str(sequences).lower()).option("splitBytes", split_bytes).load(path)


def write_bam(rows, path: str, references: list[tuple[str, int]]) -> None:
    """Write (read_id, ref_id, s, mapq, flag, cigar, sequence, quality, score, mismatches) in ranges of
    (reference, start), a file with its index each, so that a region is in few of them. References (name,
    length) go into every header; rows of others count as reads without a place, which come last."""
    from pyspark.sql import functions as F

    rows.sparkSession.dataSource.register(BamSource)
    numbers = rows.sparkSession.createDataFrame([(n, i) for i, (n, _) in enumerate(references)], "ref_id string, _ref int")
    rows = rows.join(F.broadcast(numbers), "ref_id", "left").withColumn("_ref", F.coalesce("_ref", F.lit(len(references))))
    at = F.when(F.col("_ref") < len(references), F.col("s")).otherwise(-1)
    ranged = rows.withColumn("_at", at).repartitionByRange("_ref", "_at", F.xxhash64("read_id")).sortWithinPartitions("_ref", "_at").drop("_ref", "_at")
    ranged.write.format("bam").option("references", ",".join(f"{n}:{k}" for n, k in references)).mode("append").save(path)
