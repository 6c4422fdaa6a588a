"""Reader and writer options the two sides of a format must share."""

FORMATS = ("csv", "json", "orc", "parquet")
COLUMNAR = ("orc", "parquet")

# Embedded quotes are doubled; blanks around a value belong to it.
CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {', '.join(FORMATS)}")
    return fmt
