"""Row types of the engine's tables. Order is data: pos and append_pos carry what files express by position."""

SEGMENT = "book_id string, pos bigint, id string, chapter_id string, `order` int, kind string, source string, status string"
BATCH = (
    "book_id string, batch_id string, chapter_id string, `order` int, chapter_order int, segment_ids array<string>, "
    "segments array<struct<id: string, kind: string, source: string>>, source_text string, char_count int, source_byte_count int, status string"
)
TRANSLATION = "book_id string, append_pos bigint, segment_id string, translation string, status string, review_note string"
MODEL_ROW = "segment_id string, translation string, status string, review_note string"
VIOLATION = "rule string, priority int, book_id string, entity_id string, pos bigint, detail string"

KINDS = ("book_title", "heading", "paragraph")
STATUSES = ("translated", "needs_review")
MAX_SEGMENT_BYTES, MAX_BATCH_BYTES, MAX_BATCH_SEGMENTS, CONTEXT_SEGMENTS = 1000, 20000, 24, 12
