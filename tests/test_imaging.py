import hashlib
import struct
import zlib

import pytest

from carelake.plans.bindings import encode_headers
from carelake.sources.imaging import image_files, mounted_files, read_file_header, read_header, scan_imaging

TEXT = [
    ((0x0008, 0x0018), "UI", "1.2.3.4"),
    ((0x0008, 0x0020), "DA", "20240131"),
    ((0x0008, 0x0060), "CS", "CT"),
    ((0x0010, 0x0020), "LO", "P0001"),
    ((0x0020, 0x000D), "UI", "1.2.3"),
    ((0x0020, 0x000E), "UI", "1.2.3.9"),
]
EXPECTED = {
    "dicom_id": "1.2.3.4",
    "study_date": "20240131",
    "modality": "CT",
    "patient_id": "P0001",
    "study_uid": "1.2.3",
    "series_uid": "1.2.3.9",
    "rows": 128,
    "cols": 256,
}
EXPLICIT, IMPLICIT = "1.2.840.10008.1.2.1", "1.2.840.10008.1.2"
BIG, DEFLATED, JPEG = "1.2.840.10008.1.2.2", "1.2.840.10008.1.2.1.99", "1.2.840.10008.1.2.4.50"


def element(tag, kind, value, order="<", explicit=True):
    value = value + (b"\0" if kind == "UI" else b" ") * (len(value) % 2)
    head = struct.pack(order + "HH", *tag)
    if not explicit:
        return head + struct.pack(order + "I", len(value)) + value
    if kind in ("SQ", "OB", "UN", "OW"):
        return head + kind.encode() + b"\0\0" + struct.pack(order + "I", len(value)) + value
    return head + kind.encode() + struct.pack(order + "H", len(value)) + value


def image(syntax=EXPLICIT, skip=(), before_pixels=b"", pixels=b"\x01" * 64, text=TEXT):
    order = ">" if syntax == BIG else "<"
    explicit = syntax != IMPLICIT
    body = b"".join(
        element(t, k, v.encode(), order, explicit) for t, k, v in text if t not in skip
    )
    body += before_pixels
    for tag, n in (((0x0028, 0x0010), 128), ((0x0028, 0x0011), 256)):
        if tag not in skip:
            body += element(tag, "US", struct.pack(order + "H", n), order, explicit)
    body += element((0x7FE0, 0x0010), "OW", pixels, order, explicit)
    if syntax == DEFLATED:
        deflate = zlib.compressobj(wbits=-zlib.MAX_WBITS)
        body = deflate.compress(body) + deflate.flush()
    return bytes(128) + b"DICM" + element((0x0002, 0x0010), "UI", syntax.encode()) + body


@pytest.mark.parametrize("syntax", [EXPLICIT, IMPLICIT, BIG, DEFLATED, JPEG])
def test_every_encoding_gives_the_same_header(syntax):
    assert read_header(image(syntax)) == EXPECTED


def test_nested_sequences_are_passed_over():
    undefined = struct.pack("<I", 0xFFFFFFFF)
    item = b"\xfe\xff\x00\xe0" + undefined
    item_end, sequence_end = b"\xfe\xff\x0d\xe0" + bytes(4), b"\xfe\xff\xdd\xe0" + bytes(4)
    inner = element((0x0010, 0x0020), "LO", b"WRONG")
    sequence = struct.pack("<HH", 0x0020, 0x1140) + b"SQ\0\0" + undefined
    nested = sequence + item + inner + sequence + item + inner + item_end + sequence_end
    nested += item_end + sequence_end
    sized = element((0x0020, 0x1199), "SQ", b"\xfe\xff\x00\xe0" + struct.pack("<I", len(inner)) + inner)
    assert read_header(image(before_pixels=nested + sized)) == EXPECTED


def test_absent_attributes_are_left_out():
    found = read_header(image(skip={(0x0010, 0x0020), (0x0028, 0x0010)}))
    assert "patient_id" not in found and "rows" not in found and found["cols"] == 256


@pytest.mark.parametrize("content", [b"", b"some text", bytes(128) + b"DICM\x08\x00\x18\x00UI\xff\x00abc"])
def test_other_files_are_refused(content):
    with pytest.raises(ValueError):
        read_header(content)


@pytest.mark.parametrize("syntax", [EXPLICIT, IMPLICIT, BIG, DEFLATED])
@pytest.mark.parametrize("first", [10, 140, 200, 100_000])
def test_reading_the_head_of_a_file_is_enough(tmp_path, syntax, first):
    long = element((0x0020, 0x1199), "UN", b"x" * 50_000, ">" if syntax == BIG else "<", syntax != IMPLICIT)
    (tmp_path / "a.dcm").write_bytes(image(syntax, before_pixels=long, pixels=b"\x01" * 500_000))
    assert read_file_header(str(tmp_path / "a.dcm"), first) == EXPECTED


@pytest.mark.parametrize("mounted_tasks", [None, 2])
def test_scan_reports_what_it_cannot_read(spark, tmp_path, mounted_tasks):
    no_patient = [t for t in TEXT if t[0] != (0x0010, 0x0020)]
    blank = [(t, k, "" if t == (0x0010, 0x0020) else v) for t, k, v in TEXT]
    files = {
        "patient_P1/study_1/a.dcm": image(),
        "patient_P1/study_1/deep/b.dcm": image(text=no_patient),
        "blank.dcm": image(text=blank),
        "patient_P1/fake.dcm": b"not an image",
        "patient_P1/note.txt": image(),
    }
    for name, content in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(content)
    table, errors = scan_imaging(spark, str(tmp_path), mounted_tasks=mounted_tasks)
    found = {r.file_path.rsplit("/", 1)[1]: r for r in table.collect()}
    assert set(found) == {"a.dcm", "b.dcm", "blank.dcm"}
    row = found["a.dcm"].asDict()
    assert {k: row[k] for k in EXPECTED} == EXPECTED
    assert row["patient_id_pseudo"] == hashlib.sha256(b"P0001").hexdigest()[:16]
    assert found["b.dcm"].patient_id is None and found["b.dcm"].patient_id_pseudo is None
    assert found["blank.dcm"].patient_id == "" and found["blank.dcm"].patient_id_pseudo is None
    assert [r.file_path.rsplit("/", 1)[1] for r in errors.collect()] == ["fake.dcm"]


def test_staged_headers_give_both_tables_without_opening_the_files_again(spark, tmp_path):
    root = tmp_path / "root"
    for name, content in {"a/x.dcm": image(), "a/b/y.dcm": b"none", "_old/z.dcm": image(), "w.dcm": image(), "n.txt": b""}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    listed = mounted_files(spark, f"file:{root}", "*.dcm", 2)
    wanted = image_files(spark, str(root))
    assert {r.path.rpartition(":")[2] for r in listed.collect()} == {"/" + r.path.removeprefix("file:").lstrip("/") for r in wanted.collect()}
    table, errors = scan_imaging(spark, str(root), mounted_tasks=2, staging=str(tmp_path / "headers"))
    for name in ("a/x.dcm", "a/b/y.dcm", "w.dcm"):
        (root / name).write_bytes(b"changed")
    assert sorted(r.file_path.rsplit("/", 1)[1] for r in table.collect()) == ["w.dcm", "x.dcm"]
    assert [r.file_path.rsplit("/", 1)[1] for r in errors.collect()] == ["y.dcm"]


def test_encoded_headers_read_back(spark):
    images = spark.createDataFrame(
        [("1.2.34", "20240131", "MR", "P1", "1.2", "1.2.3", 64, 32, "x.dcm")],
        "dicom_id string, study_date string, modality string, patient_id string, study_uid string,"
        "series_uid string, rows int, cols int, file_path string",
    )
    content = encode_headers(images).first().content
    assert read_header(bytes(content))["dicom_id"] == "1.2.34"
