"""Named plans over the test tables (``catalog``) and the DuckDB SQL that
states the same result independently (``oracle``)."""
