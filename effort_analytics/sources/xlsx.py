"""Minimal ``.xlsx`` sheet reader (standard library only), used inside tasks.

An xlsx file is a zip of XML parts: ``xl/workbook.xml`` names the sheets, its
relationships map each sheet to ``xl/worksheets/sheetN.xml``, text cells point
into ``xl/sharedStrings.xml`` and ``xl/styles.xml`` says which number formats
are dates. Only what a header-plus-rows sheet needs is read.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from xml.etree import ElementTree as ET

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}

# built-in number formats that display dates or times
DATE_FORMAT_IDS = set(range(14, 23)) | {45, 46, 47}
EXCEL_EPOCH = dt.datetime(1899, 12, 30)
EPOCH_1904 = dt.datetime(1904, 1, 1)

_COL = re.compile(r"([A-Z]+)")


def _col_index(ref: str) -> int:
    letters = _COL.match(ref).group(1)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{NS['m']}}}t"))


def _sheet_part(z: zipfile.ZipFile, sheet: str) -> str | None:
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    rid = None
    for s in wb.iter(f"{{{NS['m']}}}sheet"):
        if s.get("name") == sheet:
            rid = s.get(f"{{{NS['r']}}}id")
    if rid is None:
        return None
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.iter(f"{{{NS['pr']}}}Relationship"):
        if rel.get("Id") == rid:
            target = rel.get("Target").lstrip("/")
            return target if target.startswith("xl/") else "xl/" + target
    return None


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    st = ET.fromstring(z.read("xl/styles.xml"))
    custom = {}
    for nf in st.iter(f"{{{NS['m']}}}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", nf.get("formatCode", "")).lower()
        custom[int(nf.get("numFmtId"))] = ("y" in code or "d" in code)
    out = set()
    xfs = st.find("m:cellXfs", NS)
    if xfs is None:
        return out
    for i, xf in enumerate(xfs.findall("m:xf", NS)):
        fid = int(xf.get("numFmtId", "0"))
        if fid in DATE_FORMAT_IDS or custom.get(fid, False):
            out.add(i)
    return out


def _uses_1904(z: zipfile.ZipFile) -> bool:
    pr = ET.fromstring(z.read("xl/workbook.xml")).find("m:workbookPr", NS)
    return pr is not None and pr.get("date1904", "0").lower() in ("1", "true")


def _serial_to_text(v: str, from_1904: bool = False) -> str:
    """A date's serial number as text. In the 1900 system there is a 29 February 1900, so the days
    before it are one later than the others' epoch says."""
    days = float(v)
    if from_1904:
        stamp = EPOCH_1904 + dt.timedelta(days=days)
    else:
        stamp = EXCEL_EPOCH + dt.timedelta(days=days + (1 if days < 60 else 0))
    if days == int(days):
        return stamp.date().isoformat()
    return stamp.replace(microsecond=0).isoformat(sep=" ") if stamp.microsecond < 500_000 else (stamp.replace(microsecond=0) + dt.timedelta(seconds=1)).isoformat(sep=" ")


def _elements(z: zipfile.ZipFile, part: str, tag: str):
    """The elements of one kind in a part, each dropped again once it has been used."""
    with z.open(part) as stream:
        parents = []
        for event, el in ET.iterparse(stream, events=("start", "end")):
            if event == "start":
                parents.append(el)
                continue
            parents.pop()
            if el.tag == tag:
                yield el
                if parents:
                    parents[-1].remove(el)


def _cell(c, shared: list[str], date_styles: set[int], from_1904: bool) -> str | None:
    kind, style = c.get("t"), int(c.get("s", "0"))
    v = c.find("m:v", NS)
    if kind == "s":
        return shared[int(v.text)] if v is not None else None
    if kind == "inlineStr":
        is_ = c.find("m:is", NS)
        return _text(is_) if is_ is not None else None
    if kind == "b":
        return None if v is None else ("TRUE" if v.text == "1" else "FALSE")
    val = v.text if v is not None else None
    if val is not None and kind not in ("str", "e") and style in date_styles:
        val = _serial_to_text(val, from_1904)
    return val


def sheet_rows(content, sheet: str):
    """The rows of ``sheet``, one after another, as lists of text (missing cells are None); empty
    ones are left out. ``content`` is bytes or any buffer; of the sheet one row is held at a time."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        part = _sheet_part(z, sheet)
        if part is None:
            return
        m = "{" + NS["m"] + "}"
        shared = [_text(si) for si in _elements(z, "xl/sharedStrings.xml", m + "si")] if "xl/sharedStrings.xml" in z.namelist() else []
        date_styles, from_1904 = _date_styles(z), _uses_1904(z)
        for r in _elements(z, part, m + "row"):
            cells: dict[int, str | None] = {}
            for c in r.findall("m:c", NS):
                ref = c.get("r")
                cells[_col_index(ref) if ref else max(cells, default=-1) + 1] = _cell(c, shared, date_styles, from_1904)
            if cells:
                yield [cells.get(i) for i in range(max(cells) + 1)]


def sheet_records(content, sheet: str):
    """Rows after the header as ``{header: text}`` dicts, one after another (empty rows skipped)."""
    header = None
    for row in sheet_rows(content, sheet):
        if header is None:
            header = [h if h is not None else f"Unnamed: {i}" for i, h in enumerate(row)]
        elif any(v is not None for v in row):
            yield {h: (row[i] if i < len(row) else None) for i, h in enumerate(header)}


def write_workbook(path: str, sheets: dict[str, list[list]]) -> None:
    """Write a plain workbook (inline strings, numbers) -- for tests and fixtures."""
    def cell_ref(ci, ri):
        s, n = "", ci + 1
        while n:
            n, rem = divmod(n - 1, 26)
            s = chr(65 + rem) + s
        return f"{s}{ri + 1}"

    def esc(x):
        return (str(x).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))

    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        names = list(sheets)
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                             for i in range(len(names))) + "</Types>")
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{NS["m"]}" xmlns:r="{NS["r"]}"><sheets>'
                   + "".join(f'<sheet name="{esc(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
                   + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{NS["pr"]}">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                             for i in range(len(names))) + "</Relationships>")
        for i, n in enumerate(names):
            body = []
            for ri, row in enumerate(sheets[n]):
                cells = []
                for ci, v in enumerate(row):
                    if v is None:
                        continue
                    ref = cell_ref(ci, ri)
                    if isinstance(v, (int, float)) and not isinstance(v, bool):
                        cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{esc(v)}</t></is></c>')
                body.append(f'<row r="{ri + 1}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml",
                       f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{NS["m"]}"><sheetData>'
                       + "".join(body) + "</sheetData></worksheet>")
