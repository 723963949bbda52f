"""Schemas of the input documents and contracts of the warehouse tables (DDL strings)."""

DOC = "struct<title string, url string, originalTitle string, originalText string, mirroredUrl string>"
DETAIL = (
    "struct<amount string, value double, signedValue double, type string, section string, "
    "contexts array<string>, sources array<string>>"
)
TOTALS = "struct<expenditures double, decreases double, revenues double, other double, net double>"
STAFF_REPORT = (
    "struct<landUseType string, currentZoning string, requestedZoning string, futureLandUse string, "
    "waivers array<string>, findings string>"
)
ITEM = (
    "struct<number int, agendaItemId string, title string, rawTitle string, fileNumber string, background string, "
    f"supportingDocuments array<{DOC}>, folioNumbers array<string>, location string, "
    f"coordinates struct<lat double, lng double>, dollarAmounts array<string>, financialDetails array<{DETAIL}>, "
    f"financialTotals {TOTALS}, staffReport {STAFF_REPORT}, processingError string, error string>"
)
MEETING = (
    "meetingId string, meetingType string, agendaType string, isAddendum boolean, meetingDate string, "
    f"formattedDate string, sourceUrl string, agendaItems array<{ITEM}>, financialSummary string, "
    "_corrupt_record string"
)
SEGMENT = "struct<timestamp string, speaker string, text string>"
TRANSCRIPT = (
    "meeting_id string, url string, meeting_title string, meeting_date_time string, disclaimer string, "
    f"segments array<{SEGMENT}>, transcript array<{SEGMENT}>, segment_count int, scraped_at string, "
    "_corrupt_record string"
)
CHAPTER = "struct<title string, timestamp string, seconds int>"
VIDEO = (
    "struct<video_id string, title string, part int, session string, published_at string, duration string, "
    f"offset_seconds double, transcript_start_time string, chapters array<{CHAPTER}>>"
)
VIDEO_MAP = f"meeting_id string, meeting_date string, meeting_type string, videos array<{VIDEO}>, _corrupt_record string"
CAPTION = "struct<start double, end double, text string, no_speech_prob double>"
CAPTIONS = f"video_id string, audio_start double, duration double, model string, segments array<{CAPTION}>, _corrupt_record string"
ENTITY = "struct<frequency int, confidence double, score double, agendas int, transcripts int>"
ENTITY_DB = f"people map<string, {ENTITY}>, organizations map<string, {ENTITY}>, metadata map<string, string>"
STANDARD_ENTITIES = (
    "entities map<string, array<string>>, all_entities array<string>, "
    "special_rules struct<always_lowercase array<string>, always_uppercase array<string>>"
)
CASING_CONFIG = (
    "acronyms array<string>, neighborhoods array<string>, street_suffixes array<string>, skip_words array<string>"
)

# Warehouse tables: natural keys instead of generated ones.
WAREHOUSE = {
    "meetings": "id bigint, date date, meeting_type string, title string, agenda_type string, source_url string, "
    "item_count int, transcript_source_id string, year int",
    "agenda_items": "meeting_id bigint, item_pos int, item_number int, agenda_item_id string, file_number string, "
    "title string, background string, location string, coordinates struct<lat double, lng double>, "
    "dollar_amounts array<string>, fiscal_expenditures decimal(18,2), fiscal_revenues decimal(18,2), "
    "fiscal_net decimal(18,2), year int",
    "documents": "meeting_id bigint, item_pos int, doc_pos int, title string, source_url string, "
    "mirrored_url string, original_text string, year int",
    "transcript_segments": "meeting_id bigint, segment_index int, timestamp string, speaker string, text string, "
    "sec_of_day int, year int",
    "videos": "meeting_id bigint, video_id string, title string, part int, session string, published_at timestamp, "
    "duration string, duration_sec int, offset_seconds int, transcript_start_time string, year int",
    "video_chapters": "meeting_id bigint, video_id string, chapter_index int, title string, timestamp string, "
    "seconds int, year int",
}
