import io
import zipfile

from doclake.sources import archives as A


def _zip(members: dict[str, bytes]) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members.items():
            if name.endswith("/"):
                zf.writestr(zipfile.ZipInfo(name), b"")
            else:
                zf.writestr(name, data)
    return buf.getvalue()


def test_members_counts_and_table_function(spark, tmp_path):
    (tmp_path / "pack.zip").write_bytes(_zip({"dir/": b"", "dir/a-1.JPG": b"x" * 5, "notes": b"yy", "b.png": b"z"}))
    (tmp_path / "EMPTY.ZIP").write_bytes(_zip({}))
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    (tmp_path / "other.txt").write_bytes(b"ignored")
    arch = A.read_archives(spark, str(tmp_path))
    members = A.archive_members(arch)
    rows = [r for r in members.collect() if r.zip_file == "pack.zip"]
    assert sorted(r.original_filename for r in rows) == ["b.png", "dir/a-1.JPG", "notes"]
    jpg = [r for r in rows if r.original_filename == "dir/a-1.JPG"][0]
    assert jpg.content_type == "image/jpeg" and jpg.extension == ".JPG" and jpg.size == 5
    assert jpg.new_key.startswith("incoming/") and jpg.new_key.endswith(".JPG")
    assert [r for r in rows if r.original_filename == "notes"][0].content_type == "application/octet-stream"
    broken = [r for r in members.collect() if r.zip_file == "broken.zip"][0]
    assert broken.error_reason.startswith("corrupt archive")
    counts = {r.zip_file: r.extracted_count for r in A.members_per_archive(members).collect()}
    assert counts == {"pack.zip": 3, "broken.zip": 0}  # an empty archive yields no rows
    # replaying gives the same member keys
    again = {r.original_filename: r.new_key for r in A.archive_members(arch).collect() if r.zip_file == "pack.zip"}
    assert again[jpg.original_filename] == jpg.new_key
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "pack.zip").write_bytes(_zip({"b.png": b"z"}))
    keys = [r.new_key for r in A.archive_members(A.read_archives(spark, str(tmp_path))).collect()
            if r.original_filename == "b.png"]
    assert len(set(keys)) == 2  # same names in two folders stay apart
    moves = {r.zip_file: r.archive_key for r in A.archive_moves(arch).collect()}
    assert moves["pack.zip"] == "archive/pack.zip" and "other.txt" not in moves
    A.register(spark)
    arch.createOrReplaceTempView("arch")
    t = spark.sql("SELECT a.zip_file, m.* FROM arch a, LATERAL archive_members(a.zip_file, a.content) m")
    assert sorted(r.original_filename for r in t.where("zip_file = 'pack.zip'").collect()) == ["b.png", "dir/a-1.JPG", "notes"]


def test_damaged_and_encrypted_members_keep_a_row():
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        zf.writestr("good.txt", b"a" * 1000)
        zf.writestr("bad.txt", bytes(range(256)) * 40)
    data = bytearray(buf.getvalue())
    at = data.index(b"bad.txt") + len("bad.txt")
    data[at:at + 20] = b"\xff" * 20  # the compressed stream of bad.txt
    rows = {r[1]: r for r in A.expand_archive("z", bytes(data))}
    assert rows["good.txt"][7] is None and rows["good.txt"][6] == b"a" * 1000
    assert rows["bad.txt"][7].startswith("unreadable member") and rows["bad.txt"][6] is None
    locked = bytearray(_zip({"x.png": b"1"}))
    for mark, off in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
        locked[locked.index(mark) + off] |= 1  # the flag of an encrypted member
    row, = A.expand_archive("z", bytes(locked))
    assert row[1] == "x.png" and "encrypted" in row[7]
