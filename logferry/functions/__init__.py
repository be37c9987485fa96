from logferry.functions.identity import (
    bytes_text,
    headers_text,
    normalize,
    record_digest,
    with_digest,
)

__all__ = ["bytes_text", "headers_text", "normalize", "record_digest", "with_digest"]
