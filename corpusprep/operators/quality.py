"""Record quality (D1-D11, P20): declarative rules as Column predicates, one pass per table.

A rule is (name, predicate, message); ``validate`` builds the error list of every row with
``array_compact(array(when(~rule, message)...))`` and splits accepted / quarantined rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The mask shown for secret fields and the default datetime pattern.
SECRET_MASK = "**********"
DEFAULT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def errors(rules: list[tuple[str, Column]]) -> Column:
    """Messages of the failed rules (a null predicate counts as failed)."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(pred, F.lit(False)), F.lit(msg)) for msg, pred in rules]))


def validate(df: DataFrame, rules: list[tuple[str, Column]], errors_col: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with their error list)."""
    checked = df.withColumn(errors_col, errors(rules))
    return checked.where(F.size(errors_col) == 0).drop(errors_col), checked.where(F.size(errors_col) > 0)


def bounds(c, gt=None, ge=None, lt=None, le=None, multiple_of=None, finite: bool = False) -> Column:
    """Numeric bounds, multiple_of and finiteness as one predicate."""
    x = _c(c)
    conds = []
    if gt is not None:
        conds.append(x > gt)
    if ge is not None:
        conds.append(x >= ge)
    if lt is not None:
        conds.append(x < lt)
    if le is not None:
        conds.append(x <= le)
    if multiple_of is not None:
        conds.append(F.abs(x % multiple_of) < 1e-9)
    if finite:
        conds.append(~F.isnan(x) & (F.abs(x) != float("inf")))
    out = F.lit(True)
    for c_ in conds:
        out = out & c_
    return out


def text_rule(c, min_length: int | None = None, max_length: int | None = None, pattern: str | None = None) -> Column:
    """D3: length bounds and a full-match pattern."""
    x = _c(c)
    out = F.lit(True)
    if min_length is not None:
        out = out & (F.length(x) >= min_length)
    if max_length is not None:
        out = out & (F.length(x) <= max_length)
    if pattern is not None:
        out = out & x.rlike(f"^(?:{pattern})$")
    return out


def equal(c1, c2) -> Column:
    """Cross-field rule."""
    return _c(c1) == _c(c2)


def coerce(df: DataFrame, types: dict[str, str], errors_col: str = "coerce_errors") -> DataFrame:
    """Strings to the given types with ``try_cast`` (lists from JSON); a value that does not
    convert becomes null and its column name is listed."""
    msgs = []
    for c, t in types.items():
        if t.startswith("array"):
            conv = F.from_json(F.col(c), t)
        else:
            conv = F.col(c).try_cast(t)
        msgs.append(F.when(F.col(c).isNotNull() & conv.isNull(), F.lit(f"{c}: not a valid {t}")))
        df = df.withColumn(f"_{c}_conv", conv)
    df = df.withColumn(errors_col, F.array_compact(F.array(*msgs)))
    for c in types:
        df = df.withColumn(c, F.col(f"_{c}_conv")).drop(f"_{c}_conv")
    return df


def apply_defaults(df: DataFrame, spec: dict[str, dict]) -> DataFrame:
    """Per field an alias (source column), a default for null and whitespace strip."""
    out = df
    for field, s in spec.items():
        src = F.col(s.get("alias", field))
        if s.get("strip"):
            src = F.trim(src)
        if "default" in s:
            src = F.coalesce(src, F.lit(s["default"]))
        out = out.withColumn(field, src)
        if s.get("alias") and s["alias"] != field:
            out = out.drop(s["alias"])
    return out


def unknown_fields(json_col, known: list[str]) -> Column:
    """Keys of a JSON object that the schema does not know."""
    return F.array_except(F.coalesce(F.json_object_keys(_c(json_col)), F.array().cast("array<string>")),
                          F.array(*[F.lit(k) for k in known]))


def apply_unknown_policy(df: DataFrame, json_col: str, schema: T.StructType, policy: str = "ignore") -> DataFrame:
    """D7: 'ignore' parses known fields only, 'forbid' adds an error per unknown key, 'allow'
    also keeps the unknown keys as a string map."""
    parsed = F.from_json(F.col(json_col), schema)
    out = df.withColumn("_p", parsed).select("*", "_p.*").drop("_p")
    extra = unknown_fields(json_col, schema.fieldNames())
    if policy == "forbid":
        out = out.withColumn("unknown_errors", F.transform(extra, lambda k: F.concat(k, F.lit(": extra fields not permitted"))))
    elif policy == "allow":
        m = F.from_json(F.col(json_col), "map<string,string>")
        out = out.withColumn("extra", F.map_filter(m, lambda k, v: F.array_contains(extra, k)))
    return out


def one_of(c, values: list) -> Column:
    """Enum membership."""
    return _c(c).isin(*values)


def mask_secret(c) -> Column:
    """A fixed mask for any non-null secret."""
    return F.when(_c(c).isNotNull(), F.lit(SECRET_MASK))


def to_json_view(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None,
                 out: str = "json", keep: list[str] | None = None) -> DataFrame:
    """One JSON object per row with the included (or all but the excluded) fields; ``keep``
    columns are carried next to it."""
    cols = include or [c for c in df.columns if c not in (exclude or [])]
    return df.select(*(keep or []), F.to_json(F.struct(*[F.col(c) for c in cols])).alias(out))


def parse_time(c, fmt: str = DEFAULT_TIME_FORMAT) -> Column:
    """Text -> timestamp with a fixed pattern; null when it does not parse."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def format_time(c, fmt: str = DEFAULT_TIME_FORMAT) -> Column:
    """Timestamp -> text with a fixed pattern."""
    return F.date_format(_c(c), fmt)
