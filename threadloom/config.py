"""Thresholds, weights and fixed values of the curation and resolution operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Parameters of the resolution cascade and its neighbours."""

    context_weight: float = 0.50
    title_weight: float = 0.35
    subject_weight: float = 0.15
    single_match_confidence: float = 0.80
    ambiguous_gap: float = 0.20
    ambiguous_below: float = 0.80
    fuzzy_threshold: float = 85.0
    fuzzy_sort_weight: float = 0.60
    fuzzy_partial_weight: float = 0.40
    fuzzy_gap: float = 5.0
    fuzzy_ambiguous_below: float = 90.0
    postings_per_token: int = 300
    fulltext_candidates: int = 200
    min_token_length: int = 4
    canonical_fuzzy: float = 72.0
    canonical_search: float = 60.0
    novelty_overlap: float = 0.5
    prediction_score: float = 0.8
    render_depth: int = 8


SETTINGS = Settings()

# Markers of deleted text, noise words, scripture books, number words, abbreviations.
DELETED_MARKERS = ("[deleted]", "[removed]")
BAD_TERMS = ("at",)
ACRONYM_STOP_WORDS = ("a", "an", "the", "of", "in", "on", "at", "and", "or", "but", "for", "with", "to", "by")
INDEX_STOP_WORDS = (
    "a", "an", "the", "of", "in", "on", "at", "and", "or", "but", "for", "with", "to",
    "by", "from", "is", "it", "its", "as", "be", "was", "are", "were", "been",
    "do", "does", "did", "has", "have", "had", "not", "no", "so", "if", "my",
    "his", "her", "our", "their", "your", "we", "he", "she", "they", "i",
)
SCRIPTURE_BOOKS = (
    "genesis", "exodus", "leviticus", "numbers", "deuteronomy", "joshua", "judges",
    "ruth", "samuel", "kings", "chronicles", "ezra", "nehemiah", "esther", "job",
    "psalms", "psalm", "proverbs", "ecclesiastes", "isaiah", "jeremiah", "lamentations",
    "ezekiel", "daniel", "hosea", "joel", "amos", "obadiah", "jonah", "micah", "nahum",
    "habakkuk", "zephaniah", "haggai", "zechariah", "malachi", "matthew", "mark",
    "luke", "john", "acts", "romans", "corinthians", "galatians", "ephesians",
    "philippians", "colossians", "thessalonians", "timothy", "titus", "philemon",
    "hebrews", "james", "peter", "jude", "revelation", "quran", "surah",
)
NUMBER_WORDS = {
    "1": "one", "2": "two", "3": "three", "4": "four", "5": "five",
    "6": "six", "7": "seven", "8": "eight", "9": "nine", "10": "ten",
    "11": "eleven", "12": "twelve", "13": "thirteen", "14": "fourteen",
    "15": "fifteen", "16": "sixteen", "17": "seventeen", "18": "eighteen",
    "19": "nineteen", "20": "twenty", "30": "thirty", "40": "forty",
    "50": "fifty", "60": "sixty", "70": "seventy", "80": "eighty",
    "90": "ninety", "100": "one hundred", "1000": "one thousand",
    "1001": "one thousand and one", "1000000": "one million",
}
ABBREVIATIONS = (
    ("yrs", "years"), ("yr", "year"), ("vol", "volume"), ("st", "saint"), ("dr", "doctor"),
    ("mr", "mister"), ("no", "number"), ("pt", "part"), ("ch", "chapter"),
)
#: Normalised surfaces and the titles that they stand for.
ALIASES = {
    "1,000 plateaus": "A Thousand Plateaus",
    "1000 plateaus": "A Thousand Plateaus",
    "1,000 years of non-linear history": "A Thousand Years of Nonlinear History",
    "1000 years of nonlinear history": "A Thousand Years of Nonlinear History",
    "1,001 nights": "One Thousand and One Nights",
    "1001 nights": "One Thousand and One Nights",
    "arabian nights": "One Thousand and One Nights",
    "100 years in solitude": "One Hundred Years of Solitude",
    "100 years of solitude": "One Hundred Years of Solitude",
    "100 yrs of solitude": "One Hundred Years of Solitude",
    "100 yrs": "One Hundred Years of Solitude",
    "100 years of loneliness": "One Hundred Years of Solitude",
    "100 years of course": "One Hundred Years of Solitude",
    "1000 cranes": "Thousand Cranes",
    "10 of december": "Tenth of December",
    "10 days that shook the world": "Ten Days That Shook the World",
    "100 days of sodom": "The 120 Days of Sodom",
    "120 days of sodom": "The 120 Days of Sodom",
    "100 years war on palestine": "The Hundred Years' War on Palestine",
    "100 artists manifestos": "100 Artists' Manifestos",
    "1001 books to read before you die": "1001 Books You Must Read Before You Die",
    "1001 before you die": "1001 Books You Must Read Before You Die",
    "1001 books": "1001 Books You Must Read Before You Die",
    "10 myths about israel": "Ten Myths About Israel",
}
