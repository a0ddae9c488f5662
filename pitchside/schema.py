"""Column names, types and the fixed constants every operator shares."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for the same results.
# ---------------------------------------------------------------------------

# The 29 player feature columns, in table order (index 0 = Crossing).
FEATURES = [
    "Crossing", "Finishing", "HeadingAccuracy", "ShortPassing", "Volleys",
    "Dribbling", "Curve", "FKAccuracy", "LongPassing", "BallControl",
    "Acceleration", "SprintSpeed", "Agility", "Reactions", "Balance",
    "ShotPower", "Jumping", "Stamina", "Strength", "LongShots", "Aggression",
    "Interceptions", "Positioning", "Vision", "Penalties", "Composure",
    "Marking", "StandingTackle", "SlidingTackle",
]

# The 26 outfield position ratings, in table order (LS ... RB).
RATINGS = [
    "LS", "ST", "RS", "LW", "LF", "CF", "RF", "RW", "LAM", "CAM", "RAM", "LM",
    "LCM", "CM", "RCM", "RM", "LWB", "LDM", "CDM", "RDM", "RWB", "LB", "LCB",
    "CB", "RCB", "RB",
]

# Position group by the last letter of the position code:
# ...B -> DEF, ...M -> MID, ...F / ...S / ...T / ...W -> FWD; anything else has no group.
GROUP_PATTERNS = [("DEF", r"^\w*B$"), ("MID", r"^\w*M$"), ("FWD", r"^\w*[FSTW]$")]
GROUPS = [g for g, _ in GROUP_PATTERNS]
# Queries name the forward group ATK while the grouping labels it FWD.
GROUP_ALIASES = {"ATK": "FWD", "FWD": "FWD", "DEF": "DEF", "MID": "MID"}

TOP_FEATURES_PER_RATING = 12   # each rating votes for its 12 most correlated features
FEATURES_PER_GROUP = 12        # each group keeps its 12 most voted features
WEAK_DIVISOR = 4               # weak threshold = sorted(values)[n // 4]
WEIGHT_TOTAL = 10.0            # replace-mode weights always add up to 10
WEAK_WEIGHT_FACTOR = 2.0       # a weak feature weighs twice a normal one
MAX_WEAK_PLAYERS = 10          # replace mode looks at a club's first 10 players
HIST_BINS = 60                 # age histogram bins

# Feature lists used by the profiling notebook.
RADAR_FEATURES = [
    "Acceleration", "Aggression", "Agility", "Balance", "BallControl",
    "Composure", "Crossing", "Dribbling", "FKAccuracy", "Finishing",
    "HeadingAccuracy", "Interceptions", "Jumping", "LongPassing", "LongShots",
    "Marking", "Penalties",
]
# Columns of the profiling heatmap (source names after renaming); those that
# are not numeric drop out.
PROFILE_COLUMNS = [
    "Age", "Overall", "Potential", "Value", "Wage", "Acceleration", "Aggression",
    "Agility", "Balance", "BallControl", "Composure", "Crossing", "Dribbling",
    "FKAccuracy", "Finishing", "HeadingAccuracy", "Interceptions",
    "International_Reputation", "Jumping", "LongPassing", "LongShots", "Marking",
    "Penalties", "Position", "Positioning", "ShortPassing", "ShotPower",
    "Skill_Moves", "SlidingTackle", "SprintSpeed", "Stamina", "StandingTackle",
    "Strength", "Vision", "Volleys",
]
FIT_X = "Acceleration"
FIT_YS = ["Agility", "Balance", "Dribbling", "SprintSpeed"]

# ---------------------------------------------------------------------------
# Our own conventions.
# ---------------------------------------------------------------------------

SCORE_SCALE = 6                # scores are ranked and reported at 6 decimals
CORR_SCALE = 10                # correlations are ranked at 10 decimals

ID, NAME, CLUB, POSITION, GROUP = "ID", "Name", "Club", "Position", "GroupPosition"
CARD = ["ID", "Name", "Age", "Nationality", "Overall", "Club", "Position"]

# Source column names with '.', '(' or ')' are renamed on load.
RENAMES = {
    "International.Reputation": "International_Reputation",
    "Skill.Moves": "Skill_Moves",
    "Height(cm)": "Height_cm",
    "Weight(lbs)": "Weight_lbs",
}

PLAYER_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.LongType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Nationality", T.StringType()),
        T.StructField("Overall", T.IntegerType()),
        T.StructField("Club", T.StringType()),
        T.StructField("Position", T.StringType()),
        T.StructField("Height_cm", T.IntegerType()),
        T.StructField("Weight_lbs", T.IntegerType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in RATINGS + FEATURES]
)

# Profile columns of the source's player table that the derived test table does not have.
NOT_DERIVED = ["Potential", "Value", "Wage", "International_Reputation", "Skill_Moves"]

TEAM_SCHEMA = T.StructType(
    [T.StructField("Club", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in FEATURES]
)


def normalize_group(group: str) -> str:
    """Map DEF / MID / ATK / FWD to the stored group label; anything else raises."""
    try:
        return GROUP_ALIASES[group.upper()]
    except (KeyError, AttributeError):
        raise ValueError(f"{group!r} is no position group; use one of {sorted(GROUP_ALIASES)}") from None
