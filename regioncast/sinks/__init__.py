"""Result writers."""

from regioncast.sinks.files import compact, preview, write_cells, write_csv, write_result

__all__ = ["compact", "preview", "write_cells", "write_csv", "write_result"]
