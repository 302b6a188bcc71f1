from .readers import read_table, scan_libraries, scan_papers, scan_papers_features, scan_stopwords
from .writers import write_table, write_text

__all__ = [
    "read_table",
    "scan_libraries",
    "scan_papers",
    "scan_papers_features",
    "scan_stopwords",
    "write_table",
    "write_text",
]
