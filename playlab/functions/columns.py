"""Column lists and constants of the play-type task.

Fixed values (they must equal the reference's for the same results):

- REFERENCE_COLUMNS: the 30 columns kept from the play-by-play table, in the
  reference's order:
  home_team, away_team, season_type, week, posteam, posteam_type, defteam,
  side_of_field, yardline_100, quarter_seconds_remaining,
  half_seconds_remaining, game_seconds_remaining, game_half, down, drive, qtr,
  ydstogo, play_type, posteam_timeouts_remaining, defteam_timeouts_remaining,
  posteam_score, defteam_score, score_differential, ep, epa, season, wind,
  temp, roof, surface
- SAMPLE_FRACTIONS: field_goal 0.6, no_play 0.6, run 0.6, punt 0.4, pass 0.6
- EXCLUDED_LABEL: qb_kneel
- NULL_CHECKED: play_type, temp, wind
- BLANK_REPLACEMENT: an empty category becomes 'Undefined'
- FOURTH_DOWN: 4.0
"""

from __future__ import annotations

REFERENCE_COLUMNS = [
    "home_team", "away_team", "season_type", "week", "posteam", "posteam_type", "defteam",
    "side_of_field", "yardline_100", "quarter_seconds_remaining",
    "half_seconds_remaining", "game_seconds_remaining", "game_half", "down", "drive", "qtr",
    "ydstogo", "play_type", "posteam_timeouts_remaining", "defteam_timeouts_remaining",
    "posteam_score", "defteam_score", "score_differential", "ep", "epa", "season", "wind",
    "temp", "roof", "surface",
]

SAMPLE_FRACTIONS = {"field_goal": 0.6, "no_play": 0.6, "run": 0.6, "punt": 0.4, "pass": 0.6}
EXCLUDED_LABEL = "qb_kneel"
NULL_CHECKED = ["play_type", "temp", "wind"]
BLANK_REPLACEMENT = "Undefined"
FOURTH_DOWN = 4.0

LABEL = "play_type"
KEY = "row_id"
LABEL_INDEX = "play_type_idx"

# Seasons of the driver-derived fixture (FIXTURES.md section 2): 1995 to 2001.
FIRST_SEASON = 1995
HOLDOUT_SEASON = 2001
END_SEASON = 2002  # exclusive, all seasons

# Columns that are numbers but enter the models as categories.
INTEGER_CATEGORIES = ["season", "week"]
