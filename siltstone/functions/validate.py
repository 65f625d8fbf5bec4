"""Checks of proposed field values, as expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fields that may be proposed, by entity, with what they have to be.
FIELDS = {
    "account": {
        "status": ("enum", ("active", "inactive", "prospect")),
        "account_exec_staff_id": ("uuid", None),
        "industry": ("text", 128),
        "primary_contact_name": ("text", 256),
        "primary_contact_email": ("email", None),
        "notes": ("text", 4000),
    },
    "campaign": {
        "status": ("enum", ("pitch", "awarded", "in_progress", "live", "paused", "ended", "lost")),
        "budget": ("positive", None),
        "awarded_at": ("date", None),
        "live_at": ("date", None),
        "ends_at": ("date", None),
    },
}
#: What such a field looks like.
PATTERNS = {
    "uuid": r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "email": r"^(?!\.)(?!.*\.\.)[A-Za-z0-9_+.'-]*[A-Za-z0-9_+-]@([A-Za-z0-9][A-Za-z0-9-]*\.)+[A-Za-z]{2,}$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
}


def validated(entity: Column, field: Column, raw: Column) -> Column:
    """struct(ok, value, reason): an empty value counts as null except in free text; unknown fields fail."""
    out = F.struct(F.lit(False).alias("ok"), F.lit(None).cast("string").alias("value"), F.concat(F.lit("not writable: "), entity, F.lit("."), field).alias("reason"))
    for name, fields in FIELDS.items():
        for one, (kind, of) in fields.items():
            blank = F.nullif(raw, F.lit(""))
            if kind == "text":
                value, good, why = raw, F.length(raw) <= of, f"longer than {of}"
            elif kind == "enum":
                value, good, why = blank, blank.isin(*of), "not one of " + ", ".join(of)
            elif kind == "positive":
                # what is no finite number counts as no value
                number = blank.try_cast("double")
                value = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number.cast("string"))
                good, why = number > 0, "not positive"
            else:
                value, good, why = blank, blank.rlike(PATTERNS[kind]), f"not a {kind}"
            passed = value.isNull() | good
            case = F.struct(passed.alias("ok"), F.when(passed, value).alias("value"), F.when(~passed, F.lit(why)).alias("reason"))
            out = F.when((entity == name) & (field == one), case).otherwise(out)
    return out


def is_free_text(entity: Column, field: Column) -> Column:
    return (entity == "account") & field.isin(*(f for f, (kind, _) in FIELDS["account"].items() if kind == "text"))


def unchanged(entity: Column, field: Column, current: Column, proposed: Column, budget_is_text: bool = True) -> Column:
    """Whether a proposal changes nothing: free text without regard to case and outer blanks, all else exactly.

    With ``budget_is_text`` a budget is never unchanged unless both are null, since a stored budget is a text and a
    validated one a number.
    """
    loose = F.lower(F.trim(current)).eqNullSafe(F.lower(F.trim(proposed)))
    exact = current.eqNullSafe(proposed)
    if budget_is_text:
        exact = F.when((entity == "campaign") & (field == "budget"), current.isNull() & proposed.isNull()).otherwise(exact)
    return F.when(is_free_text(entity, field), loose).otherwise(exact)


#: Columns of the change log that take a field's value.
DATE_FIELDS, UUID_FIELDS = ("awarded_at", "live_at", "ends_at"), ("account_exec_staff_id",)


def typed(field: Column, value: Column) -> list[Column]:
    """The value in the one of three columns that fits its field: text, uuid or date."""
    is_date, is_uuid = field.isin(*DATE_FIELDS), field.isin(*UUID_FIELDS)
    return [F.when(~is_date & ~is_uuid, value).alias("value_text"), F.when(is_uuid, value).alias("value_uuid"), F.when(is_date, F.try_to_date(value, "yyyy-MM-dd")).alias("value_date")]
