import json

import pytest

from oreloom.operators import canonical as C
from oreloom.sources import archive as A


def export(folder, messages, text=None):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "result.json").write_text(text if text is not None else json.dumps({"name": "t", "type": "public_channel", "messages": messages}), encoding="utf-8")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    part = root / "Part"
    (part / "photos").mkdir(parents=True)
    (part / "stickers").mkdir()
    (part / "photos" / "photo_1.jpg").write_bytes(b"photo")
    (part / "photos" / "copy.jpg").write_bytes(b"photo")
    (part / "stickers" / "sticker.webp").write_bytes(b"webp")
    export(root, [{"id": 1, "type": "message", "date": "2024-01-01T10:00:00", "text": "Root"}, {"id": 3, "type": "message", "date": "2024-01-03", "text": ["a ", {"type": "bold", "text": ["b", {"text": "c"}]}, 7]}, "junk", {"id": "x"}])
    export(part, [
        {"id": 1, "type": "message", "date": "2024-01-01T10:00:00", "text": "Much longer text of the part", "photo": "photos/photo_1.jpg", "photo_file_size": 5, "extra": {"again": "photos/copy.jpg"}, "reactions": [{"type": "emoji", "count": 2}]},
        {"id": 2, "type": "message", "date": "2024-01-02", "text": "", "photo": "(File not included. Change data exporting settings to download.)", "file": "files/missing.webp"},
        {"id": "3", "type": "message", "text": ["Hi ", {"type": "custom_emoji", "text": "x", "document_id": "stickers/sticker.webp"}], "file": "../escape.pdf", "forwarded_from": "someone"},
        {"id": 4, "text": None}, {"id": 5, "text": 12},
    ])
    export(root / "Broken", None, '{"messages": [')
    export(root / "List", None, "[]")
    return C.ingest(spark, str(root)), root


def test_rejects_and_exports(tables):
    own, _ = tables
    assert sorted(r.json_path.split("/")[-2] for r in own.rejects.collect()) == ["Broken", "List"]
    rows = {r.export_id: r for r in own.exports.collect()}
    assert (rows[1].detected_export_type, rows[1].message_count, rows[1].text_messages) == ("full_text_export", 3, 2)
    assert (rows[2].detected_export_type, rows[2].real_media, rows[2].photo_keys, rows[2].date_max) == ("mixed_export", 3, 2, "2024-01-02")


def test_merge(tables):
    own, root = tables
    rows = {r.message_id: r for r in own.messages.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert (rows[1].text_plain, rows[1].source_variant_count, rows[1].has_real_photo, rows[1].message_type) == ("Root", 2, True, "message")
    assert "emoji" in rows[1].reactions_json
    assert (rows[3].text_plain, rows[3].forwarded_from, rows[3].has_real_file) == ("a bc7", "someone", False)
    assert (rows[4].text_plain, rows[5].text_plain) == ("", "12")
    assert rows[1].best_text_source == f"{root}/result.json"


def test_media(tables):
    own, root = tables
    rows = own.media.collect()
    assert sorted((r.message_id, r.media_kind) for r in rows) == [(1, "photo"), (3, "sticker")]
    photo = next(r for r in rows if r.message_id == 1)
    assert (photo.relative_path, photo.actual_file_size, photo.file_size_from_json, photo.extension) == ("photos/photo_1.jpg", 5, 5, ".jpg")
    reasons = sorted((r.message_id, r.field_path, r.missing_reason) for r in own.candidates.where("not is_real").collect())
    assert reasons == [(2, "file", "missing"), (2, "photo", "placeholder"), (3, "file", "missing")]


def test_profiles(tables, spark):
    own, root = tables
    s = C.statistics(own.messages, own.variants, own.media).first()
    assert (s.canonical_posts, s.source_variants, s.media_files, s.posts_with_text, s.posts_with_photos, s.forwarded_records) == (5, 7, 2, 3, 1, 1)
    rows = A.read_exports(spark, str(root))
    p = C.id_profile(rows).first()
    assert (p.unique_ids, p.repeated_ids, p.id_min, p.id_max) == (5, 2, 1, 5)
    assert C.key_histogram(rows).first().key == "id"
    assert {r.extension: r.files for r in C.extension_profile(A.file_inventory(spark, str(root))).collect()}[".json"] == 4
    sample = C.sample_posts(own.messages, own.media, own.variants, 2).collect()
    assert [r.message_id for r in sample] == [1, 3] and len(sample[0].exports) == 2


def test_text_and_paths():
    assert A.flat_text(["a", None, {"text": None}, {"text": ["b", {"text": "c"}]}]) == "abc"
    assert A.media_target("/x/y", "../z.jpg") is None and A.media_target("/x/y", "https://a/b.jpg") is None and A.media_target("/x/y", "/abs.jpg") is None
    assert A.is_placeholder("(File not included. Change data exporting settings to download.)") and not A.is_placeholder("photos/photo_1.jpg")


def test_order_of_rows_does_not_matter(tables, spark):
    own, root = tables
    rows = A.read_exports(spark, str(root)).repartition(3, "raw_json")
    again = C.merge(rows, A.file_inventory(spark, str(root)), str(root))
    pick = lambda t: sorted(map(str, t.messages.select("message_id", "text_plain", "raw_best_json", "reactions_json", "source_variant_count").collect()))
    assert pick(own) == pick(again)
