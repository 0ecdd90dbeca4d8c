"""Fixed values that must equal the listing model's for right results.

FIXED VALUES (closed enumerations, in their natural order):
  listing types:      scholarship, fellowship, internship, grant, conference,
                      job, competition, training
  regions:            global, africa, asia, europe, latin_america,
                      north_america, middle_east, oceania
  education levels:   high_school, undergraduate, graduate, postdoc,
                      professional, any
  listing statuses:   active, expired, flagged, removed
  verification:       basic, verified, gold
  scam risk:          low, medium, high
  run statuses:       running, success, failed, partial
  log statuses:       sent, failed, pending
  title filler words: the, for, in, of, and, a, an

FIXED VALUES (query parameters):
  fuzzy threshold 85 (inclusive); pages per index page 50;
  daily channel: 20 per run, 48 h lookback, summary 200 chars, message 4096;
  weekly digest: 15 per run, 7 days lookback, summary 150 chars;
  prompt HTML cut 50,000 chars; summary cap 300 chars; content floor 100 chars;
  error clip 500 chars.
"""

TYPES = ["scholarship", "fellowship", "internship", "grant", "conference",
         "job", "competition", "training"]
REGIONS = ["global", "africa", "asia", "europe", "latin_america",
           "north_america", "middle_east", "oceania"]
EDUCATION_LEVELS = ["high_school", "undergraduate", "graduate", "postdoc",
                    "professional", "any"]
STATUSES = ["active", "expired", "flagged", "removed"]
VERIFICATION_LEVELS = ["basic", "verified", "gold"]
SCAM_RISK_LEVELS = ["low", "medium", "high"]
RUN_STATUSES = ["running", "success", "failed", "partial"]
LOG_STATUSES = ["sent", "failed", "pending"]
FILLER_WORDS = ["the", "for", "in", "of", "and", "a", "an"]

FUZZY_THRESHOLD = 85
MAX_LINKS_PER_INDEX = 50

DAILY_MAX = 20
DAILY_LOOKBACK_HOURS = 48
DAILY_SUMMARY_MAX = 200
MESSAGE_MAX = 4096

WEEKLY_MAX = 15
WEEKLY_LOOKBACK_DAYS = 7
WEEKLY_SUMMARY_MAX = 150

PROMPT_HTML_MAX = 50_000
SUMMARY_CAP = 300
MIN_CONTENT_CHARS = 100
ERROR_CLIP = 500
DEFAULT_PAGE_SIZE = 20

# FIXED VALUES (message format): one emoji per listing type, and the fallback.
POST_EMOJI = {"scholarship": "🎓", "fellowship": "🔬", "grant": "💰",
              "internship": "💼", "conference": "🎤", "competition": "🏆",
              "training": "📚", "job": "💼"}
FALLBACK_EMOJI = "📌"

# Our own card look: the message emoji, and badges (background, text colour)
# from a palette of ours.
CARD_EMOJI = POST_EMOJI
CARD_BADGE = {"scholarship": ("#E8F1E4", "#2F5D1E"), "fellowship": ("#F3E9F7", "#5E2B73"),
              "grant": ("#FBF3D9", "#6B5208"), "internship": ("#E2F0F4", "#174F5F"),
              "conference": ("#F8E6E1", "#73301C"), "competition": ("#EAEAF8", "#33337A"),
              "training": ("#EFEFEA", "#4A4A38"), "job": ("#E0EFEA", "#14573F")}
FALLBACK_BADGE = ("#EEEEEE", "#444444")
URGENT_COLOUR = "#B3261E"
CALM_COLOUR = "#5F6B6B"

# Evaluation instant used wherever the pipeline would read the clock.
AS_OF = "2024-01-31 00:00:00"
SITE_BASE = "https://listings.example.org"
BRAND = "Listings"
