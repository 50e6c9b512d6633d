"""Reading one worksheet: the small helper that runs inside tasks.

A workbook is a zip archive of XML parts. Only the parts asked for are read, as streams. Rows without references, styles and
shared strings, as this library writes them, are cut into columns a block at a time; all others go through an XML parser.
"""

from __future__ import annotations

import posixpath
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import islice
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
#: What is read of a sheet at first: headers are often all that is asked for.
FIRST_CHUNK = 16 << 10

# The marks of plain rows, what is left of each, and two characters that XML can't hold.
CELL_END, ROW_END = 0x1F, 0x1E
PLAIN_MARKS = (
    (b'<c t="inlineStr"><is><t>', b""),
    (b'<c t="inlineStr"><is><t xml:space="preserve">', b""),
    (b"</t></is></c>", b"\x1f"),
    (b"<c><v>", b""),
    (b"</v></c>", b"\x1f"),
    (b"<c/>", b"\x1f"),
    (b"<row>", b""),
    (b"</row>", b"\x1e"),
)
# What mostly stands between two cells or rows, and what is left of it: replaced first, these shorten the text for the marks.
JOINTS = (
    (b'</t></is></c><c t="inlineStr"><is><t>', b"\x1f"),
    (b'</t></is></c></row><row><c t="inlineStr"><is><t>', b"\x1f\x1e"),
    (b"</v></c><c><v>", b"\x1f"),
)
#: How many of each mark a joint holds.
HELD = [[joint.count(mark) for mark, _ in PLAIN_MARKS] for joint, _ in JOINTS]
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def locate(path: str):
    """The Arrow filesystem of a path and the path within it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    authority, _, name = rest.lstrip("/").partition("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    store, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return store, f"{base.rstrip('/')}/{name}"


@contextmanager
def open_workbook(path: str) -> Iterator[zipfile.ZipFile]:
    store, name = locate(path)
    with store.open_input_file(name) as file, zipfile.ZipFile(file) as book:
        yield book


def ended(stream, name: str) -> Iterator[ElementTree.Element]:
    """Every element of that name once it is complete, emptied after use."""
    parser = ElementTree.XMLPullParser(("end",))
    while chunk := stream.read(CHUNK):
        parser.feed(chunk)
        for _, element in parser.read_events():
            if element.tag.endswith(name) and local(element) == name:
                yield element
                element.clear()


def local(element: ElementTree.Element) -> str:
    """An element's name without its namespace."""
    return element.tag.rpartition("}")[2]


def text_of(item: ElementTree.Element) -> str:
    """The text of a string item: its own or that of its runs, without phonetic hints."""
    out = []
    for child in item:
        kind = local(child)
        if kind == "t":
            out.append(child.text or "")
        elif kind == "r":
            out.extend(t.text or "" for t in child if local(t) == "t")
    return "".join(out)


def sheet_parts(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, archive member) in workbook order; chart sheets are left out."""
    relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {
        r.get("Id"): posixpath.normpath(posixpath.join("/xl", r.get("Target"))).lstrip("/")
        for r in relations
        if r.get("Type", "").endswith("/worksheet")
    }
    out = []
    for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if local(sheet) == "sheet":
            rid = next(v for k, v in sheet.items() if k.endswith("}id"))
            if rid in targets:
                out.append((sheet.get("name"), targets[rid]))
    return out


class SharedStrings:
    """The workbook's string table, read only as far as it is asked for."""

    def __init__(self, book: zipfile.ZipFile):
        self.known: list[str] = []
        self.rest = self._read(book)

    def _read(self, book: zipfile.ZipFile) -> Iterator[str]:
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as part:
                for item in ended(part, "si"):
                    yield text_of(item)

    def __getitem__(self, index: int) -> str:
        while len(self.known) <= index:
            following = next(self.rest, None)
            if following is None:
                raise IndexError(f"shared string {index} is missing")
            self.known.append(following)
        return self.known[index]


def column_index(reference: str) -> int:
    """0 for A1, 27 for AB7."""
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - ord("A") + 1
    return index - 1


def sheet_cells(
    stream, strings: SharedStrings, wanted: set[int] | None = None
) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number, {column: text}) for each row that has a value; numbers keep their own text.

    A caller may name the ``wanted`` columns after the first row, by filling the set. Of the others
    no text is made then; they only count as None, where they hold something.
    """
    number = 0
    places: dict[str, int] = {}
    for row in ended(stream, "row"):
        number = int(row.get("r", number + 1))
        cells: dict[int, str | None] = {}
        column = -1
        for cell in row:
            reference = cell.get("r")
            if reference is None:
                column += 1
            else:
                letters = reference.rstrip("0123456789")
                if letters not in places:
                    places[letters] = column_index(letters)
                column = places[letters]
            skipped = bool(wanted) and column not in wanted
            for part in cell:
                if part.tag.endswith("}v"):
                    value = part.text
                    if value and cell.get("t") == "s" and not (skipped and cells):
                        value = strings[int(value)]
                elif part.tag.endswith("}is"):
                    value = "?" if skipped and cells else text_of(part)
                else:
                    continue
                if value:
                    cells[column] = None if skipped else value
        if cells:
            yield number, cells


class Block:
    """Plain rows: ``cells`` in row order, null where nothing is held, and which are ``filled``, by row and column."""

    def __init__(self, cells: pa.StringArray, filled: np.ndarray, escaped: bool):
        self.cells, self.filled, self.escaped = cells, filled, escaped

    def column(self, at: int, rows: np.ndarray) -> pa.Array:
        """The text of a column in some rows."""
        width = self.filled.shape[1]
        if at >= width:
            return pa.nulls(len(rows), pa.string())
        text = self.cells.take(pa.array(rows * width + at))
        if self.escaped:
            for entity, character in ENTITIES:
                text = pc.replace_substring(text, entity, character)
        return text


def replaced(text: bytes, marks: tuple[tuple[bytes, bytes], ...]) -> tuple[bytes, list[int]]:
    """``text`` with what is left of the marks, one mark after the other, and how often each occurred."""
    counts = []
    for mark, left in marks:
        after = text.replace(mark, left)
        counts.append((len(text) - len(after)) // (len(mark) - len(left)))
        text = after
    return text, counts


def plain_block(rows: bytes) -> Block | None:
    """The cells of whole rows, if all are plain and equally long."""
    text, joints = replaced(rows, JOINTS)
    # nothing stands between the elements: of cells and rows that no joint begins, this is seen in what is left
    begun, between = joints[0] + joints[1] + joints[2] + text.count(b"><c"), joints[1] + text.count(b"</row><row>")
    text, counts = replaced(text, PLAIN_MARKS)
    counts = [n + sum(j * held[i] for j, held in zip(joints, HELD)) for i, n in enumerate(counts)]
    open_bare, open_text, close_text, open_number, close_number, nothing, open_row, close_row = counts
    cells, count = close_text + close_number + nothing, close_row
    if (
        b"<" in text
        or (open_bare + open_text, open_number, open_row) != (close_text, close_number, count)
        or not cells
        or cells % count
        or not rows.startswith(b"<row>")
        or between != count - 1
        or begun != cells
        or (b"&" in text and text.count(b"&") != sum(text.count(e.encode()) for e, _ in ENTITIES))
    ):
        return None
    if b"\r" in text:  # as a parser of XML reads line ends
        text = text.replace(b"\r\n", b"\n").replace(b"\r", b"\n")
    try:
        text.decode()
    except UnicodeDecodeError:
        return None
    data = np.frombuffer(text, np.uint8)
    ends, row_ends = np.flatnonzero(data == CELL_END), np.flatnonzero(data == ROW_END)
    width = cells // count
    if len(ends) != cells or not np.array_equal(row_ends, ends[width - 1 :: width] + 1):
        return None
    starts = np.concatenate(([0], ends[:-1] + 1))
    starts[width::width] += 1
    lengths = ends - starts
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    kept = data[(data != CELL_END) & (data != ROW_END)]
    filled = lengths > 0
    valid = np.packbits(filled, bitorder="little")
    made = pa.StringArray.from_buffers(cells, pa.py_buffer(offsets), pa.py_buffer(kept), pa.py_buffer(valid))
    return Block(made, filled.reshape(count, width), b"&" in text)


class PlainRows:
    """The plain rows that a sheet begins with, as blocks; what follows them can be read as a sheet of its own."""

    def __init__(self, stream):
        self.stream, self.rest, self.head = stream, stream.read(FIRST_CHUNK), b""
        head, mark, rest = self.rest.partition(b"<sheetData>")
        encoding = head.partition(b"encoding=")[2][1:6].lower()
        self.plain = bool(mark) and b"<!" not in head and encoding in (b"", b"utf-8")
        if self.plain:
            self.head, self.rest = head + mark, rest

    def block(self) -> Block | None:
        while self.plain:
            end = self.rest.rfind(b"</row>") + 6
            if end > 5:
                rows, rest = self.rest[:end], self.rest[end:]
                block = plain_block(rows)
                self.plain = block is not None
                if self.plain:
                    self.rest = rest
                return block
            more = self.stream.read(CHUNK)
            self.plain = bool(more)
            self.rest += more
        return None

    def read(self, size: int) -> bytes:
        """What no block was made of."""
        held, self.head, self.rest = self.head + self.rest, b"", b""
        return held or self.stream.read(size)


class Table:
    """The headers of a sheet and its rows.

    The first row with a value holds the headers; every column that has one belongs to the table,
    also behind columns without. Rows that hold nothing in these columns are passed over, and the
    table goes on behind them to the sheet's end. A header that comes again gets a number.
    """

    def __init__(self, stream, strings: SharedStrings):
        self.wanted: set[int] = set()
        self.plain = PlainRows(stream)
        self.begun: tuple[Block, int] | None = None
        first: dict[int, str] = {}
        while not first and (block := self.plain.block()):
            held = np.flatnonzero(block.filled.any(axis=1))
            if len(held):
                at = held[:1]
                first = {int(i): block.column(i, at)[0].as_py() for i in np.flatnonzero(block.filled[at[0]])}
                self.begun = block, int(at[0]) + 1
        self.cells = sheet_cells(self.plain, strings, self.wanted)
        if not first:
            first = next(self.cells, (0, {}))[1]
        self.span = sorted(first)
        self.headers: list[str] = []
        for at in self.span:
            name, again = first[at], 0
            while name in self.headers:
                again += 1
                name = f"{first[at]}_{again}"
            self.headers.append(name)

    def batches(self, places: list[int] | None = None, most: int = 10_000) -> Iterator[tuple[int, list[pa.Array]]]:
        """The number of rows and the text of the columns ``places``, by number among the headers; None: of all."""
        columns = [self.span[i] for i in (range(len(self.span)) if places is None else places)]
        self.wanted.update(columns or {-1})
        block, start = self.begun or (None, 0)
        self.begun = None
        while block := block or self.plain.block():
            own = [i for i in self.span if i < block.filled.shape[1]]
            held = start + np.flatnonzero(block.filled[start:, own].any(axis=1))
            for at in range(0, len(held), most):
                rows = held[at : at + most]
                yield len(rows), [block.column(i, rows) for i in columns]
            block, start = None, 0
        belongs = set(self.span)
        rest = (cells for _, cells in self.cells if not belongs.isdisjoint(cells))
        while chunk := list(islice(rest, most)):
            yield len(chunk), [pa.array([cells.get(i) for cells in chunk], pa.string()) for i in columns]

    def rows(self, places: list[int] | None = None) -> Iterator[list[str | None]]:
        """As ``batches``, row by row."""
        for n, columns in self.batches(places):
            yield from map(list, zip(*(c.to_pylist() for c in columns))) if columns else ([] for _ in range(n))
