"""Sources: daily file drops and incremental capture from operational tables."""

from dayfold.sources.capture import capture_increment, capture_keys, drop_date  # noqa: F401
from dayfold.sources.delimited import BAD_CELLS, parse_text_columns, read_delimited_drop  # noqa: F401
from dayfold.sources.workbook import read_workbook_drop  # noqa: F401
