"""The article record: 27 tab-separated fields, one line each."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names by position.
FIELDS = [
    "record_id", "publish_date", "source_collection", "source_name", "document_id",
    "counts", "counts_v2", "themes", "themes_v2", "locations", "locations_v2",
    "persons", "persons_v2", "organisations", "organisations_v2", "tone", "dates",
    "gcam", "sharing_image", "related_images", "image_embeds", "video_embeds",
    "quotations", "all_names", "amounts", "translation", "extras",
]
FIELD_COUNT = 27
RECORD_ID = 0
PUBLISH_DATE = 1
ALL_NAMES = 23

# Text formats.
FIELD_SEPARATOR = "\t"
ENTRY_SEPARATOR = ";"
OFFSET_SEPARATOR = ","
DAY_FORMAT = "yyyyMMdd"
STAMP_FORMAT = "yyyyMMddHHmmss"
SEGMENT_FORMAT = "yyyyMMddHHmm00"
SEGMENT_EXTENSION = ".gkg.csv"
SEGMENT_PATH_PATTERN = r"/v2/gkg/[0-9]*.gkg.csv"
SEGMENT_NAME_PATTERN = r"[0-9]*.gkg.csv"
SEGMENT_MINUTES = 15
FIRST_MARK = "20150218230000"
FIRST_KEY = "20150218230000-0"

# Fixed value: an entry of the names field that is not a name.
JUNK_NAME = "Type ParentCategory"


def article_schema() -> T.StructType:
    """Typed form of the record."""
    kinds = {"publish_date": T.DateType(), "source_collection": T.IntegerType()}
    return T.StructType([T.StructField(f, kinds.get(f, T.StringType())) for f in FIELDS])
