"""Conditional columns: sentinels, event classes, owners, flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reportarium.functions.text import strip

# Event types that count as editing.
EDITOR_EVENTS = ("Edit", "Deliver", "Modify", "Save", "Delete", "Create")

# Markers written by the user-profile feed and their replacements.
MISSING = "Does not exist"
NOT_APPLICABLE = "Not applicable"
UNIDENTIFIED = "Unidentified"
EXTERNAL = "External Resource"
LEFT = "Left Organization"
TEAM_LEAD = "Team lead"
CONTRIBUTOR = "Individual Contributer"
TECHNICAL_OWNER = "ADMINISTRATOR"


def usage_category(event_type: Column, editor_events: Sequence[str] = EDITOR_EVENTS) -> Column:
    """Editor or viewer; a null or unknown event type is a viewer event."""
    return F.when(event_type.isin(*editor_events), F.lit("Editor_events")).otherwise(
        F.lit("Viewer_events")
    )


def normal_key(key: Column) -> Column:
    """Key as compared between systems that disagree on case and padding."""
    return F.upper(F.trim(key))


def effective_owner(created_by: Column, last_author: Column) -> Column:
    """The creator, or the last author where the creator is unknown or technical."""
    technical = created_by.isNull() | (normal_key(created_by) == TECHNICAL_OWNER)
    return F.when(technical, last_author).otherwise(created_by)


def current_or_old(current: Column, old: Column) -> Column:
    """Current value; where it is the missing marker, the old one or ``Unidentified``."""
    fallback = F.when(old == MISSING, F.lit(UNIDENTIFIED)).otherwise(old)
    return F.when(current == MISSING, fallback).otherwise(current)


def clean_title(title: Column) -> Column:
    return (
        F.when(title == MISSING, F.lit(UNIDENTIFIED))
        .when(title == NOT_APPLICABLE, F.lit(EXTERNAL))
        .otherwise(title)
    )


def clean_unit(current: Column, old: Column) -> Column:
    """Current unit; without one the person left (old unit known) or is unidentified."""
    never_known = old.isNull() | (old == MISSING)
    gone = F.when(never_known, F.lit(UNIDENTIFIED)).otherwise(F.lit(LEFT))
    return F.when(current == MISSING, gone).otherwise(current)


def clean_old_unit(old: Column) -> Column:
    return F.when(old.isin(MISSING, UNIDENTIFIED), F.lit(UNIDENTIFIED)).otherwise(old)


def seniority(senior_level: Column) -> Column:
    return F.when(senior_level == "Manager", F.lit(TEAM_LEAD)).otherwise(F.lit(CONTRIBUTOR))


def truthy(value: Column) -> Column:
    """Boolean from a boolean or its text; missing or unreadable is false."""
    return F.coalesce(value.cast("string").try_cast("boolean"), F.lit(False))


def any_true(flag: Column) -> Column:
    """Aggregate: true if any row is true, false for a group of nulls."""
    return F.coalesce(F.max(flag), F.lit(False))


def is_done(status: Column) -> Column:
    """Work-list status that means finished, whatever its case or white space."""
    return F.coalesce(F.upper(strip(status)) == "TRUE", F.lit(False))
