"""Document jobs over tables of pages and files: types, links, parsing and extraction."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Leading bytes (hex, at an offset) of the file types that are told apart.
MAGIC = [
    ("application/pdf", 0, "25504446"),
    ("image/png", 0, "89504E470D0A1A0A"),
    ("image/jpeg", 0, "FFD8FF"),
    ("image/gif", 0, "47494638"),
    ("image/bmp", 0, "424D"),
    ("image/tiff", 0, "49492A00"),
    ("image/tiff", 0, "4D4D002A"),
    ("image/webp", 8, "57454250"),
    ("application/rtf", 0, "7B5C727466"),
    ("application/gzip", 0, "1F8B08"),
    ("application/x-bzip2", 0, "425A68"),
    ("application/x-7z-compressed", 0, "377ABCAF271C"),
    ("application/x-rar-compressed", 0, "526172211A07"),
    ("application/x-xz", 0, "FD377A585A00"),
    ("application/x-tar", 257, "7573746172"),
    ("application/x-ole-storage", 0, "D0CF11E0A1B11AE1"),
    ("audio/mpeg", 0, "494433"),
    ("audio/x-wav", 8, "57415645"),
    ("audio/ogg", 0, "4F676753"),
    ("audio/x-flac", 0, "664C6143"),
    ("video/mp4", 4, "66747970"),
    ("video/x-msvideo", 8, "41564920"),
    ("application/zip", 0, "504B0304"),
]
ZIP_OFFICE = {
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
}
OLE_OFFICE = {".doc": "application/msword", ".xls": "application/vnd.ms-excel", ".ppt": "application/vnd.ms-powerpoint"}
# Link schemes that documents may be read from, and the modes of parsing.
SCHEMES = ("http", "https")
PARSE_MODES = ("metadata", "hybrid", "ocr")


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]+)$", 1))


def content_type(content: Column, path: Column) -> Column:
    """MIME type by leading bytes; office files, which share theirs, by extension; null if unknown."""
    head = F.hex(F.substring(content, 1, 300))
    found = F.lit(None).cast("string")
    for mime, offset, magic in reversed(MAGIC):
        found = F.when(F.substring(head, 2 * offset + 1, len(magic)) == magic, mime).otherwise(found)

    def office(kinds: dict[str, str]) -> Column:
        named = F.lit(None).cast("string")
        for suffix, mime in kinds.items():
            named = F.when(extension(path) == suffix, mime).otherwise(named)
        return named

    return (
        F.when(found == "application/zip", office(ZIP_OFFICE))
        .when(found == "application/x-ole-storage", F.coalesce(office(OLE_OFFICE), found))
        .otherwise(found)
    )


def detect_content_types(files: DataFrame, content_col: str = "content", path_col: str = "path") -> tuple[DataFrame, DataFrame]:
    """(files with their ``content_type``, files whose type is unknown)."""
    typed = files.withColumn("content_type", content_type(F.col(content_col), F.col(path_col)))
    return typed.filter("content_type IS NOT NULL"), typed.filter("content_type IS NULL")


def link_problem(url: Column, extra_schemes: tuple[str, ...] = ()) -> Column:
    """Null for a readable link, otherwise why it is not one."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return (
        F.when(scheme.isin(*SCHEMES, *extra_schemes), None)
        .when(scheme == "file", "local file")
        .when(scheme == "", "no scheme")
        .otherwise("unsupported scheme")
    )


_DROP = r"(?is)<!--.*?-->|<(?:script)\b.*?</script\s*>|<(?:style)\b.*?</style\s*>"
_BLOCK = r"(?i)<(title|h[1-6]|p|li|td|th|pre|blockquote|caption|figcaption|dt|dd)(?:\s[^>]*)?>"
_BREAK = (
    r"(?i)</?(?:html|head|body|title|h[1-6]|p|li|td|th|pre|blockquote|caption|figcaption|dt|dd|div|ul|ol|dl|table|"
    r"thead|tbody|tr|nav|article|section|header|footer|main|aside|figure|form|hr)(?:\s[^>]*)?/?>"
)
# Names of character references come from the standard library's table. Browsers take some without the semicolon.
_NAMED = {name: text for name, text in html5.items() if name.endswith(";")}
_BARE = {name: text for name, text in html5.items() if not name.endswith(";")}
_BARE_PATTERN = "^(" + "|".join(sorted(_BARE, key=lambda name: (-len(name), name))) + ")"
_NUMBER_PATTERN = "^(#[0-9]{1,7};?|#[xX][0-9A-Fa-f]{1,6};?)"


def _lookup(names: dict[str, str], name: Column) -> Column:
    held = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.try_element_at(held, name)


def _character(number: Column) -> Column:
    """The character of a numeric reference; U+FFFD where there is none."""
    digits = F.regexp_replace(number, "[#;xX]", "")
    code = F.when(F.lower(F.substring(number, 2, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
    sound = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(sound, code).otherwise(F.lit(0xFFFD))), 8, "0")), "UTF-32")


def decode_references(text: Column) -> Column:
    """Named and numeric character references as the characters they stand for; anything else stays."""

    def one(piece: Column) -> Column:
        number = F.regexp_extract(piece, _NUMBER_PATTERN, 1)
        named = F.regexp_extract(piece, "^([A-Za-z][A-Za-z0-9]*;)", 1)
        bare = F.regexp_extract(piece, _BARE_PATTERN, 1)
        known = _lookup(_NAMED, named)
        after = lambda taken: F.substr(piece, F.length(taken) + 1)
        return (
            F.when(number != "", F.concat(_character(number), after(number)))
            .when(known.isNotNull(), F.concat(known, after(named)))
            .when(bare != "", F.concat(_lookup(_BARE, bare), after(bare)))
            .otherwise(F.concat(F.lit("&"), piece))
        )

    pieces = F.split(text, "&", -1)
    decoded = F.concat(pieces[0], F.array_join(F.transform(F.slice(pieces, 2, F.size(pieces)), one), ""))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def blocks_of(html: Column) -> Column:
    """Page markup as ``array<struct<kind, level, text>>``, with JVM expressions only."""
    c = F.regexp_replace(html, _DROP, " ")
    c = F.regexp_replace(c, _BLOCK, "\x01$1\x02")
    c = F.regexp_replace(c, _BREAK, "\x01\x02")
    c = F.regexp_replace(c, r"(?i)<br\s*/?>", " ")
    c = F.regexp_replace(c, r"<[^>]*>", "")

    def block(piece: Column) -> Column:
        kind = F.lower(F.regexp_extract(piece, "^([A-Za-z0-9]*)\x02", 1))
        body = F.regexp_replace(piece, "^[A-Za-z0-9]*\x02", "")
        body = F.trim(F.regexp_replace(decode_references(body), r"[ \t\r\n\x{A0}]+", " "))
        heading = kind.rlike("^h[1-6]$")
        return F.struct(
            F.when(heading, "heading").when(kind == "", "text").otherwise(kind).alias("kind"),
            F.when(heading, F.substring(kind, 2, 1).cast("int")).alias("level"),
            body.alias("text"),
        )

    return F.filter(F.transform(F.split(c, "\x01"), block), lambda b: b["text"] != "")


def parse_pages(pages: DataFrame, html_col: str = "html", *, mode: str = "metadata") -> DataFrame:
    """Pages with a ``result`` of structured blocks. Only the model-free mode is offered."""
    if mode not in PARSE_MODES:
        raise ValueError(f"mode must be one of {PARSE_MODES}")
    if mode != "metadata":
        raise NotImplementedError(f"{mode} needs a vision model")
    return pages.withColumn("result", F.struct(blocks_of(F.col(html_col)).alias("blocks"))).drop(html_col)


def block_rows(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per block: ``position, kind, level, text``."""
    return parsed.select(*keep, F.posexplode("result.blocks").alias("position", "block")).select(
        *keep, "position", "block.*"
    )


_SCALARS = {"string": T.StringType(), "integer": T.LongType(), "number": T.DoubleType(), "boolean": T.BooleanType()}


def json_schema_type(schema: dict) -> T.DataType:
    """A JSON schema as a Spark type; an invalid or unsupported schema is an error."""
    if not isinstance(schema, dict):
        raise ValueError("a schema must be an object")
    kind = schema.get("type")
    if isinstance(kind, list):
        real = [k for k in kind if k != "null"]
        if len(real) != 1:
            raise ValueError(f"unsupported type union {kind}")
        kind = real[0]
    if kind in _SCALARS:
        return _SCALARS[kind]
    if kind == "array":
        if "items" not in schema:
            raise ValueError("an array needs items")
        return T.ArrayType(json_schema_type(schema["items"]))
    if kind == "object":
        properties = schema.get("properties")
        if not isinstance(properties, dict) or not properties:
            raise ValueError("an object needs properties")
        unknown = set(schema.get("required", ())) - set(properties)
        if unknown:
            raise ValueError(f"required but not defined: {sorted(unknown)}")
        return T.StructType([T.StructField(n, json_schema_type(s)) for n, s in properties.items()])
    raise ValueError(f"unsupported type {kind!r}")


def extract_json(df: DataFrame, column: str, schema: dict) -> DataFrame:
    """JSON texts read into ``result`` by a JSON schema; null where a text is no JSON."""
    return df.withColumn("result", F.from_json(column, json_schema_type(schema))).drop(column)


def extract_fields(df: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """Fields of markup by regular expressions with one group; null where nothing matches."""
    fields = []
    for name, pattern in patterns.items():
        value = F.regexp_extract(F.col(column), pattern, 1)
        fields.append(F.when(value != "", value).alias(name))
    return df.withColumn("result", F.struct(*fields)).drop(column)


