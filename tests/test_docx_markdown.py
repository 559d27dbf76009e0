import zipfile

import pytest

from quire.operators import docx_markdown as D
from quire.sources.docx import read_docx_parts

NS = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:wp="http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing"'
STYLES = """<w:style w:type="paragraph" w:styleId="H1"><w:name w:val="heading 1"/><w:basedOn w:val="Base"/></w:style>
<w:style w:type="paragraph" w:styleId="Base"><w:name w:val="Normal"/><w:rPr><w:i/><w:sz w:val="22"/></w:rPr></w:style>
<w:style w:type="paragraph" w:styleId="T"><w:name w:val="Title"/></w:style>
<w:style w:type="character" w:styleId="Strong"><w:name w:val="Strong"/><w:rPr><w:b/><w:i w:val="0"/></w:rPr></w:style>"""


def run(text, props="", inner=""):
    return f'<w:r><w:rPr>{props}</w:rPr><w:t xml:space="preserve">{text}</w:t>{inner}</w:r>'


def par(*runs, style=None, props=""):
    return f"<w:p><w:pPr>{f'<w:pStyle w:val=\"{style}\"/>' if style else ''}{props}</w:pPr>{''.join(runs)}</w:p>"


def cell(text, props=""):
    return f"<w:tc><w:tcPr>{props}</w:tcPr>{''.join(par(run(t)) for t in text.split('/'))}</w:tc>"


def package(path, body, styles=STYLES, rels="", notes=None, header=None, section='<w:pgSz w:w="12240" w:h="15840"/><w:pgMar w:top="1440" w:bottom="1440" w:left="720" w:right="1000"/>'):
    with zipfile.ZipFile(path, "w") as z:
        head = '<w:headerReference w:type="default" r:id="h"/><w:headerReference w:type="first" r:id="f"/>' if header else ""
        z.writestr("word/document.xml", f"<w:document {NS}><w:body>{body}<w:sectPr>{head}{section}</w:sectPr></w:body></w:document>")
        z.writestr("word/styles.xml", f"<w:styles {NS}>{styles}</w:styles>")
        if header:
            rels += '<Relationship Id="h" Target="header1.xml"/><Relationship Id="f" Target="header2.xml"/>'
            z.writestr("word/header1.xml", f"<w:hdr {NS}>{par(run(header))}{par(run(' '))}{par(run('line 2'))}</w:hdr>")
            z.writestr("word/header2.xml", f"<w:hdr {NS}>{par(run('other'))}</w:hdr>")
        if notes is not None:
            rels += '<Relationship Id="n" Target="footnotes.xml"/>'
            z.writestr("word/footnotes.xml", f'<w:footnotes {NS}><w:footnote w:id="-1"/><w:footnote w:id="0">{par(run("sep"))}</w:footnote>' + "".join(f'<w:footnote w:id="{k}">{par(run(t))}</w:footnote>' for k, t in notes.items()) + "</w:footnotes>")
        z.writestr("word/_rels/document.xml.rels", f"<Relationships>{rels}</Relationships>")


DRAWING = '<w:drawing><wp:inline><wp:docPr name="Plan 1"/><a:blip r:embed="{}"/></wp:inline></w:drawing>'
REF = '<w:r><w:footnoteReference w:id="{}"/></w:r>'


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("docx")
    body = par(run("Main"), run(" head"), style="H1", props='<w:jc w:val="both"/>')
    body += par(run("bold", "<w:b/>"), run(" "), run(" it ", "<w:i/>"), run("gone", '<w:strike/><w:b w:val="0"/>'), run("u", '<w:u w:val="single"/>'), run("v", '<w:u w:val="none"/>'))
    body += par(run("colour ", '<w:color w:val="ff0000"/><w:sz w:val="28"/><w:rFonts w:ascii="Courier New"/>'), run("mark", '<w:highlight w:val="cyan"/>'), run("auto", '<w:color w:val="auto"/>'))
    body += par(run("see"), REF.format(10), REF.format(2), REF.format(77)) + par() + par(run("", inner='<w:br w:type="page"/>'))
    body += par(f"<w:r>{DRAWING.format('img')}</w:r>", run(" x"), f"<w:r>{DRAWING.format('none')}</w:r>")
    body += f"<w:tbl><w:tr>{cell('A', '<w:gridSpan w:val=\"2\"/>')}{cell('B|p', '<w:vMerge w:val=\"restart\"/>')}</w:tr><w:tr>{cell('1')}{cell('2/3')}{cell('', '<w:vMerge/>')}</w:tr></w:tbl>"
    body += par(run("left", inner="<w:br/>"), run("next"), props='<w:pageBreakBefore/><w:jc w:val="end"/>')
    package(folder / "CTX9.docx", body, rels='<Relationship Id="img" Target="media/image7.png"/>', notes={2: "two", 10: "ten", 5: "unused"}, header="Report")
    package(folder / "empty.docx", "", section="")
    (folder / "bad.docx").write_bytes(b"no zip")
    return read_docx_parts(spark, str(folder))


EXPECTED = """# CTX9
<!-- DOC_META: size=8.5x11.0in, orientation=portrait -->
<!-- LAYOUT_MARGIN: top=1.0in, bottom=1.0in, left=0.5in, right=0.69in -->
<!-- HEADER_START -->
Report
line 2
<!-- HEADER_END -->

## Page 1

<div align="center">
# Main head
</div>
**bold**  *it* ~~gone~~<u>u</u>v
<!-- FONT: size=14pt, family="Courier New" --><!-- STYLE: color=#FF0000 -->colour <!-- STYLE: highlight=turquoise -->markauto
see[^10][^2][^77]
<!-- PAGE_BREAK: pg_2 -->

## Page 2

![Plan 1](word/media/image7.png) x![Plan 1](media/image)
| A | A | B\\|p |
| --- | --- | --- |
| 1 | 2<br>3 | B\\|p |
<!-- PAGE_BREAK: pg_3 -->

## Page 3

<div align="right">
left
next
</div>

[^10]: ten
[^2]: two
"""


def test_markdown_of_a_whole_package(parts):
    got = {r["file"].rpartition("/")[2]: r["markdown"] for r in D.docx_markdown(parts).collect()}
    assert got["CTX9.docx"] == EXPECTED
    assert got["empty.docx"] == "# empty\n\n## Page 1\n" and "bad.docx" not in got
    assert parts.where("kind = 'error'").count() == 1


def test_styles_inherit_and_runs_of_equal_look_merge(spark, tmp_path):
    body = par(run("a"), run("b"), run("c", '<w:rStyle w:val="Strong"/>'), run("d", '<w:rStyle w:val="Strong"/><w:b/>'), style="H1")
    package(tmp_path / "s.docx", body)
    parts = read_docx_parts(spark, str(tmp_path))
    styles = {r["style"]: (r["italic"], r["size"], r["bold"]) for r in D.style_facets(parts).collect()}
    assert styles == {"H1": ("1", "11.0", None), "Base": ("1", "11.0", None), "T": (None, None, None), "Strong": ("0", None, "1")}
    last = lambda **o: D.docx_markdown(parts, **o).first()["markdown"].strip().rpartition("\n")[2]
    cue = "<!-- FONT: size=11pt -->"
    assert last() == "# abc**d**"
    assert last(merge=True) == "# abc**d**"
    assert last(inherit=True, merge=True) == f"# {cue}*ab*{cue}**cd**"


def test_a_cycle_of_styles_is_an_error(spark, tmp_path):
    two = '<w:style w:styleId="{}"><w:name w:val="x"/><w:basedOn w:val="{}"/></w:style>'
    package(tmp_path / "c.docx", par(run("a")), styles=two.format("A", "B") + two.format("B", "A"))
    with pytest.raises(ValueError, match="inherit"):
        D.style_facets(read_docx_parts(spark, str(tmp_path)))


@pytest.mark.parametrize(("name", "marks"), [("Title", "#"), ("heading 3", "###"), ("Heading", "#"), ("Heading 9", "######"), ("Subtitle", "##"), ("Normal", None), (None, None)])
def test_heading_marks(spark, name, marks):
    assert spark.createDataFrame([(name,)], "n string").select(D.heading_marks(D.F.col("n"))).first()[0] == marks
