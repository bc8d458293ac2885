"""Column-level functions (JVM built-ins only; every one stays inside whole-stage codegen
or, for array lambdas, inside the same projection)."""

from ragloom.functions.text import (  # noqa: F401
    WS_CHARS,
    byte_length,
    char_length,
    dedup_key,
    file_ext_lower,
    normalize_ws,
    trim_unicode,
)
from ragloom.functions.metadata import (  # noqa: F401
    base_metadata,
    build_document,
    chunk_id,
    file_metadata,
    hit_id_fallback,
    meta_long,
    meta_string,
    metadata_from_json,
    metadata_to_json,
    overlay_columns,
)
from ragloom.functions.vectors import cosine, dot, l2_norm, vector_narrow, vector_widen  # noqa: F401
