"""Minimal .xlsx writer for tests."""

import zipfile
from xml.sax.saxutils import escape

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _cell(reference, value, shared):
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, tuple):  # (serial day, position of the style)
        return f'<c r="{reference}" s="{value[1]}"><v>{value[0]}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value}</v></c>'
    if len(value) % 2:
        return f'<c r="{reference}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
    shared.append(value)
    return f'<c r="{reference}" t="s"><v>{len(shared) - 1}</v></c>'


def write_workbook(path, rows):
    shared = []
    body = "".join(
        f'<row r="{n}">' + "".join(_cell(f"{chr(65 + i)}{n}", v, shared) for i, v in enumerate(row)) + "</row>"
        for n, row in enumerate(rows, 1)
    )
    strings = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets><sheet name="a" sheetId="1" r:id="rId7"/>'
            '<sheet name="b" sheetId="2" r:id="rId8"/></sheets></workbook>',
        )
        archive.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships><Relationship Id="rId8" Target="worksheets/sheet1.xml"/>'
            '<Relationship Id="rId7" Target="worksheets/sheet2.xml"/></Relationships>',
        )
        archive.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{MAIN}"><sheetData/></worksheet>')
        archive.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{body}</sheetData></worksheet>')
        archive.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm"/>'
            '<numFmt numFmtId="165" formatCode="0.00&quot;d&quot;"/></numFmts>'
            '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs></styleSheet>',
        )
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{strings}</sst>')
