"""PDF text of files that the tests write: plain, packed, with character maps; and what cannot be read."""

import random
import zlib

import pytest

from quillmine.functions import pdf


def written(objects, root=1):
    """A file of numbered objects with a cross-reference table."""
    out, places = b"%PDF-1.4\n", {}
    for n, body in sorted(objects.items()):
        places[n] = len(out)
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    table = b"".join(b"%010d 00000 n \n" % places.get(n, 0) for n in range(1, max(objects) + 1))
    return out + b"xref\n0 %d\n0000000000 65535 f \n%strailer\n<< /Size %d /Root %d 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (max(objects) + 1, table, max(objects) + 1, root, len(out))


def stream(data, more=b"", packed=True):
    data = zlib.compress(data) if packed else data
    return b"<< /Length %d %s %s >>\nstream\n%s\nendstream" % (len(data), b"/Filter /FlateDecode" if packed else b"", more, data)


CATALOG, FONT = b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>"


def paged(*contents, packed=True, font=FONT, more=None):
    kids = b" ".join(b"%d 0 R" % (10 + i) for i in range(len(contents)))
    objects = {1: CATALOG, 2: b"<< /Type /Pages /Kids [%s] /Count %d /Resources << /Font << /F1 3 0 R >> >> >>" % (kids, len(contents)), 3: font} | (more or {})
    for i, c in enumerate(contents):
        objects[10 + i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (50 + i)
        objects[50 + i] = stream(c, packed=packed)
    return written(objects)


@pytest.mark.parametrize("packed", [True, False])
def test_pages_and_operators(packed):
    one = rb"BT /F1 12 Tf 72 700 Td (Hello \(PDF\) w\157rld\\) Tj 0 -14 Td [(Spa) -300 (ced) 20 (out)] TJ T* (next) ' ET"
    two = b"BT /F1 9 Tf (left) Tj 40 0 Td <7269676874> Tj ET BT (caf\xe9) Tj ET"
    assert pdf.text_of(paged(one, two, packed=packed)) == "Hello (PDF) world\\\nSpa cedout\nnext\nleft right\ncafé"


def test_character_maps():
    cmap = b"1 begincodespacerange <0000> <ffff> endcodespacerange 2 beginbfchar <0001> <0394> <0002> <00660069> endbfchar 2 beginbfrange <0010> <0012> <0041> <0020> <0021> [<0078> <0079>] endbfrange"
    font = b"<< /Type /Font /Subtype /Type0 /ToUnicode 4 0 R >>"
    raw = paged(b"BT /F1 9 Tf <00010002> Tj [<001000110012> -500 <00200021>] TJ ET", font=font, more={4: stream(cmap)})
    assert pdf.text_of(raw) == "ΔfiABC xy"


def test_object_streams_and_predictors():
    inner = {1: CATALOG, 2: b"<< /Type /Pages /Kids [10 0 R] /Count 1 >>", 10: b"<< /Type /Page /Contents [50 0 R 51 0 R] /Resources << /Font << /F1 3 0 R >> >> >>", 3: FONT}
    heads, body = b"", b""
    for n, o in inner.items():
        heads, body = heads + b"%d %d " % (n, len(body)), body + o + b" "
    rows = b"BT /F1 9 Tf (predicted) Tj ET".ljust(32)
    filtered = b"".join(bytes([2]) + bytes((rows[i + j] - (rows[i - 8 + j] if i else 0)) & 255 for j in range(8)) for i in range(0, 32, 8))
    objects = {20: stream(heads + body, b"/Type /ObjStm /N 4 /First %d" % len(heads)), 50: stream(filtered, b"/DecodeParms << /Predictor 12 /Columns 8 >>"), 51: stream(b"BT (plain) Tj ET")}
    assert pdf.text_of(written(objects, 1)) == "predicted\nplain"


def test_what_cannot_be_read():
    whole = paged(b"BT /F1 9 Tf (text) Tj ET")
    assert pdf.text_of(whole) == "text"
    assert [pdf.text_of(x) for x in (None, b"", b"no pdf", whole[:120], b"%PDF-1.4 1 0 obj << /Type /Catalog /Pages 1 0 R >> endobj")] == [""] * 5
    loop = written({1: CATALOG, 2: b"<< /Type /Pages /Kids [2 0 R 2 0 R] >>"})
    deep = written({1: CATALOG, 2: b"[" * 5000})
    other = paged(b"x").replace(b"/FlateDecode", b"/DCTDecode  ")
    assert pdf.text_of(loop) == pdf.text_of(deep) == pdf.text_of(other) == ""
    rng = random.Random(3)
    for _ in range(200):  # any damage gives a text, if only an empty one
        raw = bytearray(whole)
        for _ in range(rng.randrange(1, 12)):
            raw[rng.randrange(len(raw))] = rng.randrange(256)
        assert isinstance(pdf.text_of(bytes(raw)), str)


def test_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(paged(b"BT /F1 9 Tf (one) Tj ET", b"BT /F1 9 Tf (two) Tj ET"))
    (tmp_path / "b.pdf").write_bytes(b"broken")
    (tmp_path / "c.txt").write_bytes(b"other")
    assert {r.path.rsplit("/", 1)[1]: r.text for r in pdf.read_pdfs(spark, str(tmp_path)).collect()} == {"a.pdf": "one\ntwo", "b.pdf": ""}
    rows = spark.createDataFrame([(1, None, "old"), (2, bytearray(paged(b"BT (x) Tj ET")), "old")], "id int, body binary, text string")
    assert sorted(map(tuple, pdf.with_text(rows).collect())) == [(1, ""), (2, "x")]
