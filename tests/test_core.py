import io
import random
import re
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from veilstone import constants as K
from veilstone.functions import pii, text as tx
from veilstone.operators import detectors, entities, records, spelling
from veilstone.plans import report
from veilstone.sources import readers, workbook
from veilstone.streaming import scan


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", make(F.col("t")).alias("x")).orderBy("i").collect()]


def hits_of(spark, values):
    return [[(h.label, h.value) for h in x] for x in column(spark, values, pii.regex_hits)]


SCAN = {
    "4111111111111111": [("Aadhaar", "1111 11111111")],
    "4111-1111-1111-1111": [("Aadhaar", "4111-1111-1111")],
    "12345678901234": [],
    "123456789012345678": [("Phone_Number", "9012345678")],
    "+919876543210": [("Aadhaar", "9198 7654 3210"), ("Phone_Number", "+9198 7654 3210")],
    "+91 9876543210": [("Phone_Number", "+91 9876543210")],
    "UHID MRN0001234": [("Medical_UHID", "UHID MRN0001234"), ("Voter_ID", "MRN0001234")],
    "1234567890129800001234": [("Phone_Number", "9800001234"), ("Bank_Account", "90129800001234")],
    "FID-AB0001": [("PPP_ID", "FID-A80001")],
    "born 12/05/1999 in New Delhi": [("DOB", "12/05/1999"), ("Location", "Delhi"), ("Location", "New Delhi")],
    "a@b.co, A@B.CO": [("Email", "a@b.co")],
    "": [],
}


def test_scan_goldens(spark):
    assert hits_of(spark, list(SCAN)) == list(SCAN.values())
    assert hits_of(spark, [None]) == [[]]


def test_normalise_goldens(spark):
    got = column(spark, ["B12345678", "BO12", "so12345@x.com", "word SOS", None], tx.normalise_digits)
    assert got == ["812345678", "8012", "s012345@x.com", "word SOS", None]


def test_scan_against_plain_statement(spark):
    """Random strings of digits, letters, separators and Devanagari against a statement of the rules in Python."""
    rng = random.Random(4)
    parts = ["12", "9876", "O1", "ABCDE", "K1", " ", "-", ":", "कि", "४५", "²", "é", "@x.in", "UHID", "FID", "91", "+", "\n", "_", "."]
    values = ["".join(rng.choice(parts) for _ in range(rng.randint(3, 14))) for _ in range(1500)]

    def fix(m):
        r = m.group()
        return r.translate(str.maketrans(*K.DIGIT_LOOKALIKES)) if sum(c.isdigit() for c in r) >= max(2, len(r) - 2) else r

    def normal(t):
        return re.sub(r"(\d{4})\s?(\d{4})\s?(\d{4})", r"\1 \2 \3", re.sub(r"\w{4,}", fix, t))

    assert column(spark, values, tx.normalise_digits) == [normal(v) for v in values]
    plain = {"Aadhaar": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}\b", "PAN": r"\b[A-Z]{5}\d{4}[A-Z]\b", "Bank_Account": r"(?<!\d)\d{14,18}(?!\d)", "PPP_ID": r"\b(?:PPP|PPPID|FAMILYID|FID)[_\-:\s]*[A-Z0-9]{6,10}\b"}
    for label, pattern in plain.items():
        want = []
        for v in values:
            seen, out = set(), []
            for m in re.finditer(pattern, normal(v)):
                key = re.sub(r"[\s-]", "", m.group().strip()).lower()
                if key not in seen:
                    seen.add(key)
                    out.append(m.group().strip())
            want.append(out)
        assert column(spark, values, lambda c, x=label: tx.let(tx.normalise_digits(c), lambda n: pii.label_hits(n, x))) == want, label


def test_masks(spark):
    cases = [
        ("AADHAAR", "2345 0000 1234", "XXXX XXXX 1234"), ("PAN", "ABCDE1234F", "ABCDE****F"), ("EMAIL", "abcdef@x.org", "ab****@x.org"), ("EMAIL", "ab@x.org", "a*@x.org"), ("EMAIL", "none", "*****@***.com"),
        ("PERSON", "Ravi Kumar", "R.K."), ("PERSON", "Ravi Kumar Singh", "R.K. S."), ("PERSON", " ", "[NAME]"), ("DOB", "12/05/1999", "**/**/1999"), ("DOB", "1", "**/**/****"), ("IP_ADDRESS", "1.2.3.4", "[LOCATION REDACTED]"),
        ("Phone_Number", "98 7654 3210", "XXXXXX3210"), ("Bank_Account", "12345678", "****5678"), ("Credit_Card", "4111111111111111", "XXXX-XXXX-XXXX-1111"), ("Passport", "K1234567", "KXXXXX67"), ("Passport", "K1", "KXXXXXX"), ("ORG", "x", "[ORG REDACTED]"), ("Voter_ID", "x", "[REDACTED]"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, l string, v string, w string")
    rows = df.select("i", "w", pii.mask(F.col("l"), F.col("v")).alias("m")).orderBy("i").collect()
    assert [r.m for r in rows] == [r.w for r in rows]


def test_text_functions(spark):
    assert column(spark, ["", None, "हिन्दी", "abc", "हिन्दी abc", "ह abcdefg"], tx.language) == ["English", "English", "Hindi", "English", "Hindi", "English"]
    assert column(spark, ["|a|b|\n|---|---|\n|1|2|", "## T\n**x** _y_  z", "a\n\n\n\nb", ' <p data-x="1">q</p>', None], tx.sanitise) == ["a b\n\n1 2", "T\nx y z", "a\n\nb", "q", None]
    assert column(spark, ["|a|b|\n---\n- c\n\n"], tx.markdown_lines) == [["a  b", "c"]]
    assert column(spark, [" a \r\n\r\n b\rc"], tx.text_lines) == ["a\nb\nc"]
    assert [len(x) for x in column(spark, ["x" * n for n in (0, 1800, 1801, 3400, 3401)], tx.chunks)] == [1, 1, 2, 2, 3]
    assert column(spark, ["Please drive the car to work."], tx.title_names) == [["drive the car to work"]]
    none = F.array().cast("array<string>")
    assert column(spark, ["The Minister met Minister, Ravi and hospital Staff"], lambda c: tx.missed_words(c, none)) == [["Minister", "Ravi", "Staff"]]


def test_summary_texts(spark):
    det, masked, left, named = (column(spark, ["call 9876543210", "x"], lambda c, f=f: f(pii.regex_hits(c))) for f in (pii.detected_text, pii.masked_text, pii.not_detected_text, pii.detected_values_text))
    assert det == ["[Phone_Number] 9876543210", "None"] and masked == ["XXXXXX3210", "None"] and named == ["Phone Number: 9876543210", "None"]
    assert "Phone Number" not in left[0] and left[1].startswith("Aadhaar, PAN, Phone Number")


def test_spelling(spark):
    terms = spark.createDataFrame([("the", 100), ("then", 50), ("receipt", 5), ("hte", 0)], "term string, term_count long")
    rows = spark.createDataFrame([(1, "teh reciept 42 ABC a@b zzzzzz is", "x"), (2, None, None), (3, "हिन्दी teh", ""), (4, "", "y")], "id int, text string, corrected_text2 string")
    got = {r.id: r.corrected_text for r in spelling.correct(rows, "text", terms).collect()}
    assert got == {1: "the receipt 42 ABC a@b zzzzzz is", 2: None, 3: "हिन्दी teh", 4: ""}
    assert spelling.edits("ab", "ba") == 1 and spelling.edits("abcdef", "abc") == 3
    assert spelling.correct(rows.limit(0), "text", terms).count() == 0
    by_join = {r.id: r.corrected_text for r in spelling.correct(rows, "text", terms, max_terms=1).collect()}
    assert by_join == got
    part = {r.id: r.corrected_text for r in spelling.correct(rows, "text", terms, where="id > 1").collect()}
    assert part == got | {1: "teh reciept 42 ABC a@b zzzzzz is"}


def test_spelling_by_join_equals_the_broadcast(spark):
    sheet = spark.read.parquet("/root/testdata/sf0.001/sheet3.parquet").select("record_id", "full_extracted_text", F.lit(1).alias("text_key"), F.lit("x").alias("changes"))
    terms = spark.read.parquet("/root/testdata/sf0.001/spell_dictionary.parquet")
    one, two = (sorted(map(tuple, spelling.correct(sheet, "full_extracted_text", terms, max_terms=n).collect()), key=str) for n in (500_000, 3))
    assert one == two and one


def test_spelling_model(spark):
    terms = spark.createDataFrame([("the", 100)], "term string, term_count long")
    rows = spark.createDataFrame([(1, "teh one"), (2, "teh"), (3, "teh null"), (4, "हिन्दी teh"), (5, "teh " * 700)], "id int, text string")
    seen = {1: "THE ONE", 2: "  ", 3: None}

    def fix(texts):
        return texts.map(lambda t: seen[1] if t == "teh one" else seen[2] if t == "teh" else None if t == "teh null" else str(len(t)))

    got = {r.id: r.corrected_text for r in spelling.correct(rows, "text", terms, model=fix).collect()}
    assert got == {1: "THE ONE", 2: "teh", 3: "the null", 4: "हिन्दी teh", 5: "2000"}

    def broken(texts):
        raise RuntimeError("no model")

    assert {r.id: r.corrected_text for r in spelling.correct(rows.limit(3), "text", terms, model=broken).collect()} == {1: "the the", 2: "the", 3: "the null"}


def test_calls_that_fail_or_hang():
    import time

    from veilstone.operators import backends

    with pytest.raises(TimeoutError):
        backends.within(0.05, time.sleep, 2)
    with pytest.raises(ZeroDivisionError):
        backends.within(5, lambda: 1 / 0)
    assert backends.each_or_none(lambda xs: [1 / x for x in xs], [1, 0, 2]) == [1.0, None, 0.5] and backends.each_or_none(lambda xs: xs[1:], [1, 2]) == [None, None]


def make_records(spark):
    files = spark.createDataFrame([(1, "/a/x.JPG"), (2, "/a/y.txt"), (3, "/b/y.TXT"), (4, "/a/z.tif"), (5, "/a/w.png")], "record_id long, path string")
    raw = spark.createDataFrame([("/a/x.JPG", "Dr. Ravi Kumar has PAN ABCDE1234F"), ("/a/y.txt", " \n"), ("/b/y.TXT", "Shri Mohan of Pune")], "path string, raw_text string")
    return records.with_language(records.build_records(files, raw, ["record_id"]).withColumn("corrected_text", F.col("raw_text")))


def test_records(spark):
    got = {r.record_id: (r.source_file, r.file_type, r.raw_text, r.is_failed) for r in make_records(spark).collect()}
    assert got == {1: ("x.JPG", "IMAGE", "Dr. Ravi Kumar has PAN ABCDE1234F", False), 2: ("y.txt", "TXT", "[EMPTY: y.txt]", True), 3: ("y.TXT", "TXT", "Shri Mohan of Pune", False), 5: ("w.png", "IMAGE", "[OCR FAILED: w.png]", True)}


def test_report_without_models(spark):
    s2 = {r.record_id: r for r in report.sheet2(make_records(spark), ["record_id"]).collect()}
    assert s2[1].regex_detected_names.startswith("Dr. Ravi Kumar has PAN")
    assert (s2[5].hiner_predicted_type, s2[1].bert_ner_extracted_text) == ("Load Failed", "N/A")
    s3 = {r.record_id: r for r in report.sheet3(make_records(spark), ["record_id"]).collect()}
    assert s3[1].detected_pii_with_tags == "[PAN] ABCDE1234F" and s3[5].detected_pii_with_tags == "OCR Failed" and s3[3].anonymized_pii_output == "[LOCATION REDACTED]"
    s1 = report.sheet1(make_records(spark)).collect()
    assert len(s1) == 4 and {(r.total_files_processed, r.files_with_pii, r.files_with_names) for r in s1} == {(4, 2, 0)}


def test_report_with_scripted_models(spark):
    def say(pairs):
        return lambda texts: texts.map(lambda t: [p for p in pairs if p[1].strip("# ").lower() in (t or "").lower()])

    detectors.register("HiNER", say([("ORG", "Ravi"), ("PER", "ravi"), ("PERSON", "Mohan"), ("B-PER", "Pune"), ("LOC", "##Pune")]))
    detectors.register("Presidio", say([("PAN", "ABCDE1234F"), ("PERSON", "Mohan")]))
    try:
        s2 = {r.record_id: r for r in report.sheet2(make_records(spark), ["record_id"]).collect()}
        assert s2[1].hiner_extracted_text.startswith("PER: Dr. Ravi Kumar") and "ORG: Ravi" in s2[1].hiner_extracted_text
        assert "Pune" not in s2[3].hiner_extracted_text.replace("Shri Mohan of Pune", "") and s2[5].hiner_predicted_type == "OCR Failed"
        s3 = {r.record_id: r for r in report.sheet3(make_records(spark), ["record_id"]).collect()}
        assert s3[1].detected_pii_with_tags == "[PAN] ABCDE1234F" and s3[3].detected_pii_with_tags == "[Location] Pune | [PERSON] Mohan"
        assert {r.model_name[:5]: r.files_with_names for r in report.sheet1(make_records(spark)).collect()}["HiNER"] == 2
    finally:
        detectors.unregister("HiNER"), detectors.unregister("Presidio")


def test_detectors_read_their_models_own_output(spark):
    df = spark.createDataFrame([(1, "a " * 300 + "b" * 500), (2, "bad"), (3, None), (4, "  ")], "id int, t string")

    def detect(texts, **asked):
        assert not texts.eq("bad").any() or len(texts) == 1, "fails with others, and alone"
        if texts.eq("bad").any():
            raise ValueError
        return texts.map(lambda t: [{"entity_group": "GIVENNAME", "word": "Ra##vi "}, {"entity_group": "GIVENNAME", "word": "RAVI"}, {"entity_group": "LEN", "word": str(len(t))}, {"entity_group": "X", "word": " "}])

    got = {r.id: [(h.source, h.label, h.value) for h in r.h] for r in df.select("id", detectors.detector_hits("Piiranha", F.col("t"), detect).alias("h")).collect()}
    assert got == {1: [("Piiranha", "GIVENNAME", "Ravi"), ("Piiranha", "LEN", "512")], 2: [], 3: [], 4: []}

    def gliner(texts, labels, threshold):
        assert len(labels) == 13 and threshold == 0.5
        return texts.map(lambda t: [{"label": "bank account", "text": "1#2", "score": 0.7}, {"label": "person", "text": "low", "score": 0.4}])

    assert [(h.label, h.value) for h in df.filter("id = 1").select(detectors.detector_hits("GLiNER", F.col("t"), gliner).alias("h")).first().h] == [("BANK_ACCOUNT", "1#2")]
    presidio = lambda texts: texts.map(lambda t: [{"entity_type": "PERSON", "start": 0, "end": 3}])
    named = spark.createDataFrame([("Ravi",), ("Ravi हिन्दी",)], "t string").select(detectors.detector_hits("Presidio", F.col("t"), presidio).alias("h")).collect()
    assert [[h.value for h in r.h] for r in named] == [["Rav"], []]


def test_entity_models_read_chunks_and_skip_those_they_fail_on(spark):
    text = "".join(chr(97 + i % 26) for i in range(4000))

    def detect(texts):
        if any(t.startswith(text[1600:1610]) and len(t) == 1800 for t in texts):
            raise ValueError
        return texts.map(lambda t: [{"entity_group": "PER", "word": t[:3] + str(len(t))}])

    row = spark.createDataFrame([(text,), (None,)], "t string").select(detectors.model_entities("x", F.col("t"), detect).alias("e")).collect()
    assert [[e.value for e in r.e] for r in row] == [[text[:3] + "1800", text[3200:3203] + "800"], []]


def test_bounds_of_words_in_any_script(spark):
    """Where Unicode's words and ASCII's differ, as in Python."""
    values = ["ABCDE1234Fक", "कABCDE1234F", "é1234 5678 9012", "x²345678901234", "2345 6789 0123é", "UHID: ABC12345क", "k@ı.İK", "a@b.com_x@y.org", "a.b.c@@d.ef"]
    plain = {"Aadhaar": r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}\b", "PAN": r"\b[A-Z]{5}\d{4}[A-Z]\b", "Medical_UHID": r"(?i)\b(?:UHID|PMRN|IPD|EPISODE)[\s\:\.\-]*[A-Z]{2,6}[\.\-]?\d{5,15}\b", "Email": r"(?i)[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"}
    for label, pattern in plain.items():
        want = [[m.group() for m in re.finditer(pattern, v)] for v in values]
        assert column(spark, values, lambda c, x=label: pii.matches(c, x)) == want, label


def test_merge_keeps_first_by_priority(spark):
    df = spark.createDataFrame([([("Regex", "Email", "a@b.c")], [("GLiNER", "EMAIL", "A@B.C"), ("GLiNER", "PHONE", " ")])], f"a {pii.HIT}, b {pii.HIT}")
    got = df.select(pii.merge_hits(F.col("a"), F.col("b")).alias("x")).first().x
    assert [(h.source, h.value) for h in got] == [("Regex", "a@b.c")]


def test_readers(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.html").write_text("<p>First line<div>inner <b>bold</b></div><script>no</script><td>tiny</td>")
    (tmp_path / "d" / "b.txt").write_bytes("  x \r\n\r\n y\xff".encode("latin-1"))
    body = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t> one </w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>a</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>b</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", body)
    (tmp_path / "c.docx").write_bytes(buffer.getvalue())
    (tmp_path / "bad.docx").write_bytes(b"no zip")
    (tmp_path / "e.pdf").write_bytes(b"%PDF")
    (tmp_path / "f.png").write_bytes(b"img")
    (tmp_path / "skip.csv").write_text("x")
    files = readers.scan_files(spark, str(tmp_path))
    got = {r.path.rsplit("/", 1)[-1]: r.raw_text for r in readers.read_texts(files).collect()}
    assert got == {"a.html": "First lineinnerboldtiny\ninnerbold", "b.txt": "x\ny", "c.docx": "one\na | b", "bad.docx": "", "e.pdf": ""}
    readers.register_backend("pdf", lambda b: " p1 \n\n p2 ")
    readers.register_backend("image", lambda b: "")
    try:
        got = {r.path.rsplit("/", 1)[-1]: r.raw_text for r in readers.read_texts(files).collect()}
        assert got["e.pdf"] == "p1\np2" and got["f.png"] == "[OCR EMPTY: f.png]"
    finally:
        readers.unregister_backend("pdf"), readers.unregister_backend("image")
    assert readers.scan_files(spark, str(tmp_path / "none")).count() == 0


def test_ocr_chain(spark, tmp_path, monkeypatch):
    for n in ("a", "b", "c", "d_x_"):
        (tmp_path / f"{n}.PNG").write_bytes(n.encode())
    files = readers.scan_files(spark, str(tmp_path))

    def first(content):
        if content == b"b":
            raise OSError
        return "" if content in (b"c", b"d_x_") else "\ufeff## **Head**\n<b>text</b> "

    readers.register_backend("image", first, lambda c: "second" if c == b"b" else " ", lambda c: "third" if c == b"c" else None)
    try:
        got = {r.path.rsplit("/", 1)[-1]: r.raw_text for r in readers.read_texts(files).collect()}
    finally:
        readers.unregister_backend("image")
    assert got == {"a.PNG": "Head\ntext", "b.PNG": "second", "c.PNG": "third", "d_x_.PNG": "[OCR EMPTY: dx.PNG]"}
    monkeypatch.setattr(readers, "OCR_SECONDS", 0.2)
    slow = lambda c: __import__("time").sleep(1) if c == b"2" else "ok"
    assert readers.read_images(list("12345"), [b"1", b"2", b"3", b"4", b"5"], [slow]) == ["ok", "[OCR FAILED: 2]", "[OCR FAILED: 3]", "ok", "ok"]


def test_images_are_made_smaller_and_sizes_fit(spark):
    tried = []

    def read(content, side):
        tried.append(side)
        if side > 600:
            raise MemoryError
        return "read"

    assert readers.by_smaller_images(read)(b"") == "read" and tried == [2000, 1000, 500]
    df = spark.createDataFrame([(4000, 1000), (1999, 2001), (10, 20)], "w int, h int").select(readers.fitted_size(F.col("w"), F.col("h")).alias("s"))
    assert [tuple(r.s) for r in df.collect()] == [(2000, 500), (int(1999 * (2000 / 2001)), int(2001 * (2000 / 2001))), (10, 20)]


def test_manifest_and_exchanged_texts(spark, tmp_path):
    (tmp_path / "m.json").write_text('[{"image": "a.png", "out": "a.txt"},\n {"image": "b.png", "out": "b.txt"}]')
    assert sorted(map(tuple, readers.manifest(spark, str(tmp_path / "m.json")).collect())) == [("a.png", "a.txt"), ("b.png", "b.txt")]
    (tmp_path / "none.json").write_text("[]")
    with pytest.raises(ValueError):
        readers.manifest(spark, str(tmp_path / "none.json"))
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_bytes("\ufeff text\n".encode() + b"\xff")
    assert [r.text for r in readers.exchanged_texts(spark, str(tmp_path / "t")).collect()] == ["text\n\ufffd"]


def test_pdf_pages_read_before_a_failure_count():
    def pages(content):
        yield "one\n\n two"
        raise ValueError

    assert readers.read_document(".pdf", b"", {"pdf": [lambda b: [], pages]}) == "one\ntwo"


def test_workbook(spark, tmp_path):
    df = spark.createDataFrame([("a<b", 1, "Hindi", None), ("c", 2, "x", "[PAN] y")], "name string, n int, language string, detected_pii string")
    workbook.write_workbook(str(tmp_path / "r.xlsx"), {"Model Summary": df, "Empty": df.limit(0)})
    with zipfile.ZipFile(tmp_path / "r.xlsx") as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
        assert "a&lt;b" in sheet and sheet.count("<row") == 3 and 's="2"' in sheet
        assert z.read("xl/worksheets/sheet2.xml").decode().count("<row") == 1
        assert '<col min="1" max="1" width="8" customWidth="1"/>' in sheet and len(z.namelist()) == 7


def test_workbook_loses_nothing(spark, tmp_path):
    from xml.etree import ElementTree

    odd, long = "a\x07b\r\nc _x0007_ \ufffe", "क😀" * 30_000
    df = spark.createDataFrame([(odd, long)], "pii string, t string")
    workbook.write_workbook(str(tmp_path / "r.xlsx"), {"S": df})
    with zipfile.ZipFile(tmp_path / "r.xlsx") as z:
        cells = [[[t.text or "" for t in r.iter("{http://schemas.openxmlformats.org/spreadsheetml/2006/main}t")] for r in ElementTree.fromstring(z.read(f"xl/worksheets/sheet{i}.xml")).iter("{http://schemas.openxmlformats.org/spreadsheetml/2006/main}row")] for i in (1, 2)]
        assert workbook.OVERFLOW in z.read("xl/workbook.xml").decode()
    back = re.sub("_x([0-9A-F]{4})_", lambda m: chr(int(m.group(1), 16)), cells[0][1][0])
    assert back == odd and cells[0][1][1] + "".join(r[-1] for r in cells[1][1:]) == long
    assert all(len(p.encode("utf-16-le")) // 2 <= 32_767 for p in workbook.parts(long))


def test_stream(spark, tmp_path):
    rows = spark.createDataFrame([(1, "call 9876543210"), (2, None)], "id long, text string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = scan.tagged(scan.read_stream(spark, str(tmp_path / "in"), rows.schema))
    scan.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    got = {r.id: r.masked for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "XXXXXX3210", 2: "None"} == {r.id: r.masked for r in scan.tagged(rows).collect()}


def test_entities_groups(spark):
    df = spark.createDataFrame([([("b-per", "x"), ("PERSON", "Ravi "), ("org", "RAVI"), ("ORG", "Hospital"), ("GPE", "##Pune")],)], f"e {entities.ENTITIES}")
    assert [(e.label, e.value) for e in df.select(entities.buckets(F.col("e")).alias("x")).first().x] == [("OTHER", "x"), ("PER", "Ravi"), ("LOC", "Pune")]


def test_entry_and_names():
    import __spark_entry__ as e

    names = set(e.queries())
    assert set(e.oracle_sql()) <= names and {"pii_summary", "sheet1", "sheet2", "sheet3"} <= names
