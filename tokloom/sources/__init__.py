from tokloom.sources.files import discover_files, read_code_files, read_text_lines  # noqa: F401
from tokloom.sources.tables import code_files, load  # noqa: F401
