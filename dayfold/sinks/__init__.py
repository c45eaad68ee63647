"""Run-keyed tables, commits, and the pure forms of the writers."""

from dayfold.sinks.archive import archive_committed, input_files  # noqa: F401
from dayfold.sinks.writers import (  # noqa: F401
    Attempt,
    Committed,
    new_entries,
    read_commits,
    read_current,
    read_history,
    read_runs,
    replace_run,
)
