"""trawl: text retrieval and crawl analytics expressed as Spark DataFrame plans.

Sub-packages
------------
functions   Column-expression builders (tokenizer, scoring formulas, HTML/URL helpers, stemmer).
sources     Readers and writers (JSONL corpus, query/seed files, index and page stores).
operators   DataFrame -> DataFrame operators (index build, ranking, reports, pages, crawl planning).
streaming   Structured Streaming forms of de-duplication, incremental indexing and progress.
plans       Named plans over the test tables and their DuckDB oracle SQL.
"""

from trawl.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
