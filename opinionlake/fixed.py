"""Fixed values.

Everything in this file is data, not logic: labels, thresholds and word lists
whose exact content decides the results.  Operators take them as parameters;
these are the defaults.
"""

# --- source tags and the label vocabulary -----------------------------------
POSTS = "reddit"
ARTICLES = "scraping"
SOURCES = (POSTS, ARTICLES)
LABELS = ("positive", "neutral", "negative")
UNKNOWN_AUTHOR = "Unknown"
UNDATED = "NaT"
FIRST_RUN = "00000000_000000"
POST_SITE = "https://www.reddit.com"

# --- thresholds -------------------------------------------------------------
SHORT_TEXT_THRESHOLD = 0.05
ARTICLE_THRESHOLD = 0.20
IQR_FACTOR = 1.5
EXPECTED_RUNS = 7
MIN_PARAGRAPH = 80
MIN_LEMMA = 3
HINT_MIN_CHARS = 40
HINT_MIN_HITS = 4
SHORT_CHARS = 50
SOURCE_GAP_POINTS = 8
TREND_STEP = 0.05

# --- columns every gold record must fill, and the ones whose nulls are counted
REQUIRED = ("url", "title", "author", "published_at", "body_text", "source")
NULL_CHECKED = (
    "url", "title", "author", "published_at", "body_text", "body_text_clean",
    "source", "vader_compound", "text_processed",
)

# --- HTML -------------------------------------------------------------------
PAGE_TAGS = ("h1", "h2", "h3", "h4", "h5", "p", "span", "div", "a", "li", "strong", "em", "time")
BYLINE_MARK = "Posted by"
LINK_CONTAINER = "post-container"

# --- metadata keys ----------------------------------------------------------
META_TITLE = "og:title"
META_AUTHOR = "author"
META_PUBLISHED = "article:published_time"
META_READING_TIME = "twitter:data2"

# --- typographic marks deleted together with ASCII punctuation --------------
TYPOGRAPHIC_MARKS = "‘’“”–—"

# --- paragraphs holding one of these are boilerplate ------------------------
BOILERPLATE = (
    "Welcome to our", "Your email address", "Required fields", "Comment*",
    "Name*", "Email*", "Notify me", "This site uses", "Learn how your comment",
    "Live Comments", "Leave a Reply", "Cancel reply", "Posted by",
)

# --- Spanish function words removed from tokens -----------------------------
SPANISH_STOPWORDS = tuple("""
    el la los las un una unos unas lo de del al ante con contra desde durante
    en entre hacia hasta para por segun sin sobre tras y e o u que se su sus
    le les es son fue ser no mas muy ya si como esta este esto esa ese eso pero
    tambien todo todos toda todas ni ha han hay mi tu nos me te
""".split())

# --- domain vocabulary removed from tokens ----------------------------------
DOMAIN_STOPWORDS = tuple("""
    real madrid club team player players season game games match matches
    football laliga liga league play playing played time week weeks day days
    year years month today yesterday tomorrow gol goal goals minute minutes
    half side thing things way ways lot bit guy guys people fan fans head like
    just going get got really want think know say said make made see
""".split())

# --- words never shown as co-words of an aspect -----------------------------
COWORD_BLOCKLIST = tuple("""
    el la los las un una lo de del que se su es no mas como para por con en
    play time week day gol goal head like just going thing way people really
""".split())

# --- general English function words (the default base stop list) ------------
ENGLISH_STOPWORDS = tuple("""
    a about above after again against all also although always am among an and
    another any anyone anything are as at be became because been before being
    below between both but by can cannot could did do does doing done down
    during each either else enough even ever every few for from further had
    has have having he her here hers herself him himself his how however i if
    in into is it its itself less made many may me might mine more most much
    must my myself neither never no nobody none nor not nothing now of off
    often on once one only onto or other others our ours ourselves out over
    own per perhaps quite rather same several she should since so some such
    than that the their them themselves then there these they this those
    through thus to together too under until up upon us very was we well were
    what when where whether which while who whom whose why will with within
    without would yet you your yours yourself
""".split())

# --- irregular English forms (the default lemma table) ----------------------
LEMMAS = {
    "won": "win", "wins": "win", "winning": "win", "lost": "lose", "loses": "lose",
    "losing": "lose", "losses": "loss", "scored": "score", "scores": "score",
    "scoring": "score", "signed": "sign", "signs": "sign", "signing": "sign",
    "transfers": "transfer", "deals": "deal", "contracts": "contract",
    "injuries": "injury", "injured": "injure", "went": "go", "gone": "go",
    "came": "come", "coming": "come", "took": "take", "taken": "take", "gave": "give",
    "given": "give", "left": "leave", "leaving": "leave", "began": "begin",
    "better": "well", "best": "good", "worse": "bad", "worst": "bad",
    "children": "child", "men": "man", "women": "woman", "feet": "foot",
    "coaches": "coach", "managers": "manager", "teams": "team", "fans": "fan",
}

# --- padded Spanish function words of the language hint ---------------------
SPANISH_HINTS = (
    " el ", " la ", " los ", " las ", " de ", " que ", " en ", " un ", " una ",
    " por ", " con ", " del ", " para ",
)

# --- language profiles: frequent function words -----------------------------
LANGUAGE_PROFILES = {
    "en": tuple("the of and to in is that it for was on with be by as this are at from".split()),
    "fr": tuple("de la le et les des en un du une que pour est qui par dans sur au pas avec".split()),
    "de": tuple("der die und in den von zu das mit sich auf des für ist nicht dem im ein als eine".split()),
    "es": tuple("de la que el en y los se del las por un no con su una es para al lo".split()),
}

# --- aspects and their display labels ---------------------------------------
ASPECTS = {
    "mourinho": ("mourinho", "mou"),
    "mbappe": ("mbappe", "kylian"),
    "vinicius": ("vinicius", "vini"),
    "carvajal": ("carvajal", "dani"),
    "transfers": ("transfer", "signing", "sign", "deal", "contract"),
    "injuries": ("injury", "injured", "fitness", "knock", "discomfort"),
    "arbeloa": ("arbeloa",),
    "bellingham": ("bellingham", "jude"),
    "valverde": ("valverde", "fede"),
    "barcelona": ("barcelona", "barca", "barça", "barsa"),
    "clasico": ("clasico", "clásico"),
    "tchouameni": ("tchouameni", "tchoumeni", "tchouaméni"),
    "ancelotti": ("ancelotti", "carlo", "ancheloti"),
}
ASPECT_LABELS = {
    "mourinho": "Mourinho", "mbappe": "Mbappé", "vinicius": "Vinicius Jr.",
    "carvajal": "Carvajal", "transfers": "Fichajes", "injuries": "Lesiones",
    "arbeloa": "Arbeloa", "bellingham": "Bellingham", "valverde": "Valverde",
    "barcelona": "Barcelona", "clasico": "El Clásico", "tchouameni": "Tchouaméni",
    "ancelotti": "Ancelotti",
}
SCOPE_LABELS = {"all": "All sources", POSTS: "Reddit", ARTICLES: "Web scraping"}

# --- KPI names, categories and their order ----------------------------------
KPI_NAMES = {
    "pipeline_run_ts": "Pipeline run timestamp",
    "total_records": "Total records",
    "records_reddit": "Records - Reddit",
    "records_scraping": "Records - Web scraping",
    "body_text_missing_rate": "Body text missing rate",
    "schema_compliance_rate": "Schema compliance rate",
    "duplicate_rate": "Duplicate rate",
    "expected_runs_weekly": "Expected runs weekly",
    "actual_runs_scraping": "Actual runs - Web scraping",
    "actual_runs_reddit": "Actual runs - Reddit",
    "ingestion_compliance_scraping": "Ingestion compliance - Web scraping",
    "ingestion_compliance_reddit": "Ingestion compliance - Reddit",
    "outlier_rate_reading_time_min": "Outlier rate - reading_time_min",
    "outlier_rate_score": "Outlier rate - score",
    "outlier_rate_num_comments": "Outlier rate - num_comments",
}
KPI_CORE = (
    "total_records", "records_reddit", "records_scraping", "duplicate_rate",
    "schema_compliance_rate", "body_text_missing_rate",
)
KPI_WHOLE_NUMBERS = (
    "total_records", "records_reddit", "records_scraping",
    "actual_runs_scraping", "actual_runs_reddit", "expected_runs_weekly",
)
KPI_CATEGORY_ORDER = (
    "Core", "Completeness", "Quality", "Volume", "Ingestion", "Text", "Distribution", "Other",
)

# --- lexicon scoring rules (Hutto & Gilbert, ICWSM 2014) --------------------
BOOST = 0.293
CAPS_BOOST = 0.733
NEGATION = -0.74
NORMALISER = 15.0
EXCLAMATION = 0.292
QUESTION = 0.18
QUESTION_MAX = 0.96
NEGATORS = tuple("""
    aint arent cannot cant couldnt darent didnt doesnt ain't aren't can't
    couldn't daren't didn't doesn't dont hadnt hasnt havent isnt mightnt mustnt
    neither don't hadn't hasn't haven't isn't mightn't mustn't neednt needn't
    never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt
    werent oughtn't shan't shouldn't uh-uh wasn't weren't without wont wouldnt
    won't wouldn't rarely seldom despite
""".split())
INTENSIFIERS = tuple("""
    absolutely amazingly awfully completely considerable considerably decidedly
    deeply enormous enormously entirely especially exceptional exceptionally
    extreme extremely fabulously fully greatly highly hugely incredible
    incredibly intensely major majorly more most particularly purely quite
    really remarkably so substantially thoroughly total totally tremendous
    tremendously unbelievably unusually utter utterly very
""".split())
DAMPENERS = tuple("""
    almost barely hardly kinda less little marginal marginally occasional
    occasionally partly scarce scarcely slight slightly somewhat sorta
""".split())

# --- a starter lexicon; production runs load a published one with read_lexicon
STARTER_LEXICON = {
    "good": 1.9, "great": 3.1, "excellent": 2.7, "amazing": 2.8, "love": 3.2,
    "best": 3.2, "better": 1.9, "win": 2.8, "won": 2.7, "happy": 2.7, "hope": 1.9,
    "brilliant": 2.8, "perfect": 2.7, "beautiful": 2.9, "strong": 2.3, "fun": 2.3,
    "glad": 2.0, "proud": 2.1, "safe": 1.9, "support": 1.7, "like": 1.5, "nice": 1.8,
    "success": 2.7, "superb": 3.1, "thanks": 1.9, "wonderful": 2.7, "yes": 1.7,
    "bad": -2.5, "worst": -3.1, "worse": -2.1, "awful": -2.0, "terrible": -2.1,
    "hate": -2.7, "lose": -1.7, "lost": -1.3, "loss": -1.3, "sad": -2.1, "angry": -2.3,
    "poor": -2.1, "pain": -2.3, "problem": -1.7, "fail": -2.5, "failure": -2.3,
    "fear": -2.2, "crisis": -3.1, "ugly": -2.3, "weak": -1.9, "wrong": -2.1,
    "injured": -1.7, "injury": -1.8, "disaster": -3.1, "horrible": -2.5, "no": -1.2,
}
