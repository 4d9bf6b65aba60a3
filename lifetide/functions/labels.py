"""Status flags and transaction-type labels.

The ``*_sql`` builders return Spark SQL CASE text over column names (parsed
once in the JVM).
The label strings are fixed values: downstream dashboards filter on them, so
they must be spelled exactly as below.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must be spelled exactly like this for result parity).
# Event types read from the source:
REWARD_SEARCH = "reward_search"
MILES_EARNED = "miles_earned"
MILES_REDEEMED = "miles_redeemed"
# Transaction types:
ENGAGEMENT = "Engagement"
MILES = "Miles"
MILES_AND_ENGAGEMENT = "Miles & Engagement"
CHURNED = "Churned"
NO_ACTIVITY = "No Activity"
# Transaction sub-types (besides Engagement, Churned and No Activity):
MILES_EARNED_AND_REDEEMED = "Miles Earned & Redeemed"
MILES_REDEMPTION_ONLY = "Miles Redemption Only"
MILES_EARNED_ONLY = "Miles Earned Only"
ENGAGEMENT_EARN_REDEEM = "Engagement & Earn & Redeem"
ENGAGEMENT_MILES_REDEMPTION = "Engagement & Miles Redemption"
ENGAGEMENT_MILES_EARNED = "Engagement & Miles Earned"
# Long-format user types, in report order, and the miles measures:
USER_TYPES = ["new_users", "retained", "resurrected", "tot_churned", "churned", "active"]
MILES_TYPES = [MILES_EARNED, MILES_REDEEMED]
# Row kinds of the long tables:
TOTAL = "TOTAL"
BREAKDOWN = "BREAKDOWN"
# ---------------------------------------------------------------------------

ACTIVE_TYPES = [ENGAGEMENT, MILES, MILES_AND_ENGAGEMENT]


def trns_type_sql(activity: str = "activity", trns: str = "trns", churned: str = "false") -> str:
    """Engagement / Miles / Miles & Engagement for an active period, else
    Churned when ``churned`` holds, else No Activity.  A searched CASE:
    first match wins and NULL measures never match."""
    a, t = activity, trns
    return (
        f"CASE WHEN {a} > 0 AND {t} = 0 THEN '{ENGAGEMENT}' "
        f"WHEN {a} = 0 AND {t} > 0 THEN '{MILES}' "
        f"WHEN {a} > 0 AND {t} > 0 THEN '{MILES_AND_ENGAGEMENT}' "
        f"WHEN {churned} THEN '{CHURNED}' "
        f"ELSE '{NO_ACTIVITY}' END"
    )


def trns_sub_type_sql(
    activity: str = "activity",
    trns: str = "trns",
    earned: str = "miles_earned",
    redeemed: str = "miles_redeemed",
    churned: str = "false",
    strict: bool = False,
) -> str:
    """Nine ordered branches.

    ``strict=False`` keeps the parity rule, whose "earned and redeemed"
    branches look at the redeemed amount only, so any redemption reads as
    "Earned & Redeemed".  ``strict=True`` tests earned and redeemed.
    """
    a, t, e, r = activity, trns, earned, redeemed
    both = f"{e} <> 0 AND {r} <> 0" if strict else f"{r} <> 0"
    miles_only = f"{a} = 0 AND {t} > 0"
    mixed = f"{a} > 0 AND {t} > 0"
    return (
        f"CASE WHEN {a} > 0 AND {t} = 0 THEN '{ENGAGEMENT}' "
        f"WHEN {miles_only} AND {both} THEN '{MILES_EARNED_AND_REDEEMED}' "
        f"WHEN {miles_only} AND {e} = 0 THEN '{MILES_REDEMPTION_ONLY}' "
        f"WHEN {miles_only} AND {r} = 0 THEN '{MILES_EARNED_ONLY}' "
        f"WHEN {mixed} AND {both} THEN '{ENGAGEMENT_EARN_REDEEM}' "
        f"WHEN {mixed} AND {e} = 0 THEN '{ENGAGEMENT_MILES_REDEMPTION}' "
        f"WHEN {mixed} AND {r} = 0 THEN '{ENGAGEMENT_MILES_EARNED}' "
        f"WHEN {churned} THEN '{CHURNED}' "
        f"ELSE '{NO_ACTIVITY}' END"
    )


def day_flags_sql(is_new: str, is_active: str, prev_active: str, value: str = "CAST(1 AS BIGINT)") -> dict[str, str]:
    """The five status flags of one user-period, as SQL text.

    Each flag is ``value`` when it holds, else NULL: new_user, active,
    retained (active, not new, previous period active), resurrected
    (active, not new, previous inactive) and churned (inactive, not new,
    previous active).  ``is_new`` is tested null-safely (IS TRUE);
    ``is_active`` and ``prev_active`` must be never-NULL booleans.
    """
    new = f"({is_new}) IS TRUE"
    return {
        "new_user": f"CASE WHEN {new} THEN {value} END",
        "active": f"CASE WHEN {is_active} THEN {value} END",
        "retained": f"CASE WHEN NOT {new} AND {is_active} AND {prev_active} THEN {value} END",
        "resurrected": f"CASE WHEN NOT {new} AND {is_active} AND NOT {prev_active} THEN {value} END",
        "churned": f"CASE WHEN NOT {new} AND NOT {is_active} AND {prev_active} THEN {value} END",
    }


def status_labels(churned: str = "false", strict_subtype: bool = False) -> dict[str, str]:
    """trns_type and trns_sub_type over the standard measure columns, as SQL text."""
    return {
        "trns_type": trns_type_sql("activity", "trns", churned),
        "trns_sub_type": trns_sub_type_sql("activity", "trns", "miles_earned", "miles_redeemed", churned, strict_subtype),
    }
