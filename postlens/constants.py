"""Fixed values the results depend on.

Everything in this module is a plain constant that must keep these exact
values for results to match the original analysis: JSON path selections,
tracked keyword lists, default topic patterns, sentiment class intervals,
label prefixes and the US state names and postal abbreviations.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: JSON path selections (output column = path joined by "-").
# Each entry is (path, Spark type name).
# ---------------------------------------------------------------------------
PATHS_SHORT = [
    (("text",), "string"),
    (("extended_tweet", "full_text"), "string"),
    (("lang",), "string"),
    (("retweeted_status", "user", "screen_name"), "string"),
    (("retweeted_status", "text"), "string"),
    (("retweeted_status", "extended_tweet", "full_text"), "string"),
    (("user", "id"), "bigint"),
    (("user", "name"), "string"),
    (("user", "screen_name"), "string"),
    (("user", "location"), "string"),
    (("user", "description"), "string"),
    (("user", "followers_count"), "bigint"),
    (("user", "friends_count"), "bigint"),
    (("user", "listed_count"), "bigint"),
    (("user", "favourites_count"), "bigint"),
    (("user", "statuses_count"), "bigint"),
    (("place", "name"), "string"),
    (("place", "full_name"), "string"),
    (("place", "place_type"), "string"),
    (("place", "country_code"), "string"),
    (("place", "country"), "string"),
    (("place", "bounding_box", "type"), "string"),
    (("place", "bounding_box", "coordinates"), "array<array<array<double>>>"),
]

PATHS_LONG = [
    (("text",), "string"),
    (("extended_tweet", "full_text"), "string"),
    (("lang",), "string"),
    (("retweeted_status", "user", "screen_name"), "string"),
    (("retweeted_status", "text"), "string"),
    (("retweeted_status", "extended_tweet", "full_text"), "string"),
    (("user", "id"), "bigint"),
    (("user", "name"), "string"),
    (("user", "screen_name"), "string"),
    (("user", "location"), "string"),
    (("user", "description"), "string"),
    (("user", "followers_count"), "bigint"),
    (("user", "friends_count"), "bigint"),
    (("user", "listed_count"), "bigint"),
    (("user", "favourites_count"), "bigint"),
    (("user", "statuses_count"), "bigint"),
    (("user", "created_at"), "string"),
    (("user", "profile_background_color"), "string"),
    (("user", "profile_sidebar_border_color"), "string"),
    (("user", "profile_sidebar_fill_color"), "string"),
    (("user", "profile_text_color"), "string"),
    (("user", "profile_use_background_image"), "boolean"),
    (("user", "default_profile"), "boolean"),
    (("place", "name"), "string"),
    (("place", "full_name"), "string"),
    (("place", "place_type"), "string"),
    (("place", "country_code"), "string"),
    (("place", "country"), "string"),
    (("place", "bounding_box", "type"), "string"),
    (("place", "bounding_box", "coordinates"), "array<array<array<double>>>"),
    (("entities",), "variant"),
    (("user", "protected"), "boolean"),
    (("user", "verified"), "boolean"),
    (("user", "contributors_enabled"), "boolean"),
    (("user", "geo_enabled"), "boolean"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: tracked keyword lists (list 0 is intentionally empty).
# ---------------------------------------------------------------------------
KEYWORDS_0: list[str] = []
KEYWORDS_1 = ["JoeBiden", "realDonaldTrump", "biden", "trump", "presidentialelection",
              "presidential", "election", "electionnight", "vote", "iwillvote", "america",
              "govote", "uselection", "president"]
KEYWORDS_2 = ["JoeBiden", "realDonaldTrump", "biden", "trump", "presidentialelection",
              "electionnight", "iwillvote", "govote", "uselection"]
KEYWORDS_3 = ["biden", "trump", "JoeBiden", "realDonaldTrump"]
KEYWORDS_4 = ["iwillvote", "govote", "uselection", "vote"]
KEYWORDS_5 = ["uselection", "president", "presidentialelection", "presidential", "electionnight"]
KEYWORD_LISTS = [KEYWORDS_0, KEYWORDS_1, KEYWORDS_2, KEYWORDS_3, KEYWORDS_4, KEYWORDS_5]

# ---------------------------------------------------------------------------
# FIXED VALUES: text columns in priority order, topic patterns, suffixes.
# ---------------------------------------------------------------------------
TEXT_PRIORITY = ["extended_tweet-full_text", "retweeted_status-extended_tweet-full_text",
                 "retweeted_status-text", "text"]
TOPIC_A_PATTERN = "(Trump|Donald|realDonaldTrump|republican)"
TOPIC_B_PATTERN = "(Biden|Joe|JoeBiden|democrat)"
TOPIC_A_SUFFIX = "contains_trump"
TOPIC_B_SUFFIX = "contains_biden"

# ---------------------------------------------------------------------------
# FIXED VALUES: sentiment classes, half-open [lo, hi), first match wins.
# ---------------------------------------------------------------------------
SENTIMENT_CLASSES = [
    ("tneg", -1.0, -0.7),
    ("neg", -0.7, -0.2),
    ("neutre", -0.2, 0.2),
    ("pos", 0.2, 0.7),
    ("tpos", 0.7, 1.0),
]
NO_CLASS = "0"

# FIXED VALUES: label prefixes (both, first only, second only, neither).
LABEL_BOTH = "TB"
LABEL_FIRST = "T"
LABEL_SECOND = "B"
LABEL_NEITHER = "N"

# FIXED VALUES: message markers used to route raw capture messages, in order.
ROUTE_STATUS = "in_reply_to_status"
ROUTE_DELETE = "delete"
ROUTE_LIMIT = "limit"
ROUTE_WARNING = "warning"

# FIXED VALUES: records per capture file, missing-value text in map feeds.
RECORDS_PER_FILE = 20000
NO_DATA = "No data"

# Level-0 sentiment normalisation constant (compound = s / sqrt(s^2 + alpha)).
COMPOUND_ALPHA = 15.0

# ---------------------------------------------------------------------------
# FIXED VALUES: the fifty US states, name and postal abbreviation, in
# alphabetical order of name (the order used for "first match").
# ---------------------------------------------------------------------------
US_STATES = [
    ("Alabama", "AL"), ("Alaska", "AK"), ("Arizona", "AZ"), ("Arkansas", "AR"),
    ("California", "CA"), ("Colorado", "CO"), ("Connecticut", "CT"), ("Delaware", "DE"),
    ("Florida", "FL"), ("Georgia", "GA"), ("Hawaii", "HI"), ("Idaho", "ID"),
    ("Illinois", "IL"), ("Indiana", "IN"), ("Iowa", "IA"), ("Kansas", "KS"),
    ("Kentucky", "KY"), ("Louisiana", "LA"), ("Maine", "ME"), ("Maryland", "MD"),
    ("Massachusetts", "MA"), ("Michigan", "MI"), ("Minnesota", "MN"), ("Mississippi", "MS"),
    ("Missouri", "MO"), ("Montana", "MT"), ("Nebraska", "NE"), ("Nevada", "NV"),
    ("New Hampshire", "NH"), ("New Jersey", "NJ"), ("New Mexico", "NM"), ("New York", "NY"),
    ("North Carolina", "NC"), ("North Dakota", "ND"), ("Ohio", "OH"), ("Oklahoma", "OK"),
    ("Oregon", "OR"), ("Pennsylvania", "PA"), ("Rhode Island", "RI"), ("South Carolina", "SC"),
    ("South Dakota", "SD"), ("Tennessee", "TN"), ("Texas", "TX"), ("Utah", "UT"),
    ("Vermont", "VT"), ("Virginia", "VA"), ("Washington", "WA"), ("West Virginia", "WV"),
    ("Wisconsin", "WI"), ("Wyoming", "WY"),
]
