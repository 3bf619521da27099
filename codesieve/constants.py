"""Values the results depend on.  They are data, kept together and in plain text."""

from __future__ import annotations

# --- Fixed values: needed as they are for equal results -------------------------------------

# Namespace of the name-based (version 5) finding ids.
FINDING_NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"

# Base score per vulnerability type; every other type counts 0.
BASE_SCORES = {
    "command_injection": 10,
    "deserialization": 9,
    "file_inclusion": 8,
    "path_traversal": 8,
    "sql_injection": 7,
    "ssrf": 6,
    "xss": 3,
}

# Bonus for each fragment found in a finding's path.
PATH_BONUS = {"controllers/": 3, "routes/": 3}

# Repository score: bonus per star threshold (strictly above), recency, framework, controllers folder.
STAR_BONUS = {500: 5, 2000: 10}
RECENT_SECONDS = 180 * 24 * 60 * 60
RECENT_BONUS = 4
FRAMEWORK_BONUS = 8
CONTROLLERS_BONUS = 6

# Name fragments of repositories that are noise.
NOISE_NAMES = ("tutorial", "example", "demo", "practice", "cheatsheet", "awesome-")

# Framework label and its indicators, in order of precedence.
FRAMEWORK_INDICATORS = {
    "laravel": ("artisan", "laravel"),
    "symfony": ("symfony",),
    "express": ("express",),
    "koa": ("koa",),
    "fastify": ("fastify",),
    "nestjs": ("nestjs", "@nestjs"),
    "django": ("django",),
    "flask": ("flask",),
    "fastapi": ("fastapi",),
    "spring": ("spring-boot", "spring-web"),
    "aspnetcore": ("microsoft.aspnetcore", "startup.cs", "program.cs"),
    "php": ("composer.json",),
}

# Folders that are never scanned: short default list and the longer deployed list.
IGNORED_PATHS = ("node_modules", "vendor", "dist", "build", "target", "migrations")
IGNORED_PATHS_WITH_TESTS = IGNORED_PATHS + (
    "tests", "test", "__tests__", "spec", "specs", "*.Tests", "*.Tests.*", "*.Test",
)

# File extension -> language of the patterns' file type.
EXTENSIONS = {
    "php": ("php", "php3", "php4", "php5", "php7", "php8", "pht", "phtml"),
    "python": ("py", "pyi"),
    "javascript": ("js", "jsx", "cjs", "mjs", "vue"),
    "typescript": ("ts", "tsx", "cts", "mts"),
    "java": ("java", "jsp", "jspx", "properties"),
    "csharp": ("cs",),
}

# Languages that borrow another language's patterns.
PATTERN_LANGUAGE = {"typescript": "javascript"}

# Spelling of languages in search results -> our key.
LANGUAGE_KEYS = {
    "c#": "csharp",
    "javascript": "javascript",
    "typescript": "typescript",
    "php": "php",
    "python": "python",
    "java": "java",
}

# Static-analysis post-processing.
SAST_CWES = ("22", "78", "79", "80", "89", "327", "502", "611", "918")
TRIAGE_CWES = ("73", "78", "80", "89", "327", "502", "611", "918")
SAST_CAP = 60
HIGH_SEVERITY = 4
VERDICT_WEIGHT = {
    "exploitable": 5,
    "likely_exploitable": 4,
    "needs_review": 3,
    "unlikely_exploitable": 2,
    "false_positive": 1,
}

# Context lines around a finding, and around a static-analysis flaw.
CONTEXT_LINES = 3
EXCERPT_LINES = 8

# Order in which vulnerability categories are worked off; unknown types come last.
CATEGORY_PRIORITY = {
    "command_injection": 1,
    "deserialization": 2,
    "path_traversal": 3,
    "file_inclusion": 3,
    "sql_injection": 4,
    "ssrf": 5,
    "xss": 6,
    "open_redirect": 6,
}

# Words in a path that make a code-search hit more interesting.
PATH_TAGS = {
    "sensitive_area": ("admin", "internal", "debug", "test", "dev"),
    "file_exchange": ("upload", "import", "backup"),
    "account_recovery": ("reset", "forgot", "password"),
    "api": ("api",),
}

# Default thresholds and the default search template.
MIN_STARS = 100
MAX_REPO_SIZE_MB = 200
SEARCH_TEMPLATES = ("stars:>{min_stars} fork:false archived:false {pushed} language:{language}",)
SEARCH_LANGUAGES = ("php", "javascript", "typescript", "python", "java", "csharp")
SEARCH_CAP = 1000

# --- end of fixed values ---------------------------------------------------------------------
