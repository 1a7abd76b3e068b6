"""Word lists, patterns and lookup tables the results depend on."""

# --- fixed values: HTML ------------------------------------------------------------------
VOID_TAGS = [
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image",
    "img", "input", "isindex", "keygen", "link", "menuitem", "meta", "nextid", "param", "source",
    "spacer", "track", "wbr",
]
CLEAN_TEXT_DROPPED = ["nav", "footer", "header"]

# --- fixed values: URLs ------------------------------------------------------------------
PAGE_EXTENSIONS = [".html", ".htm", ".php", ".asp", ".aspx", ".jsp", ".cfm"]
BLOCKED_EXTENSIONS = [
    ".pdf", ".jpg", ".jpeg", ".png", ".gif", ".css", ".js", ".xml", ".zip", ".doc", ".docx", ".svg", ".ico",
]
BLOCKED_EXTENSIONS_WITH_MEDIA = BLOCKED_EXTENSIONS + [".mp4", ".mp3", ".wav"]
MALFORMED_CHARACTERS = r'[<>"`{}|^]'
NOT_A_DOMAIN_CHARACTERS = ["(", ")", '"', "'", "\\", ";"]
MAX_URL_LENGTH = 2000

JS_BAD_PREFIXES = [
    "javascript:", "mailto:", "tel:", "#", "data:", "blob:", "about:",
    ");", "};", "{", "}", "(", ")", "[", "]", "/*", "*/", "//",
    "var ", "let ", "const ", "function", "return", "if(", "for(",
    "window.", "document.", "console.", "$(",
]
JS_BAD_PATTERNS = [
    r"[{}();]",
    r"^\s*[A-Z_]+\s*$",
    r"\\{2,}",
    r"[\"'].*[\"']",
    r"^\d+$",
    r"[<>]",
    r"\s{2,}",
    r"^[^a-zA-Z0-9/._-]",
]
JS_ALLOWED_SHAPE = r"^[a-zA-Z0-9/_.-]+(?:\?[a-zA-Z0-9&=._-]*)?(?:#[a-zA-Z0-9._-]*)?$"

CSS_BAD_PREFIXES = ["data:", "#", "javascript:", "mailto:", "tel:"]
CSS_ASSET_EXTENSIONS = [
    ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".svg", ".webp", ".ico",
    ".woff", ".woff2", ".ttf", ".otf", ".eot",
    ".css", ".js", ".json", ".xml",
]
CSS_PAGE_EXTENSIONS = [".html", ".htm", ".php", ".asp", ".aspx", ".jsp"]

# --- fixed values: link discovery --------------------------------------------------------
# In priority order: on one page the first method that finds a URL keeps it.
DISCOVERY_METHODS = [
    "anchor", "area", "javascript", "meta", "form", "data_attribute", "css", "json_ld", "microdata",
    "http_header", "comment",
]
DATA_LINK_ATTRIBUTES = [
    "data-href", "data-url", "data-link", "data-src", "data-target", "data-action", "data-path",
    "data-route", "data-endpoint", "data-ajax-url", "data-load-url", "data-redirect-url",
]
JS_URL_PATTERNS = [
    r"""window\.location\s*=\s*["']([^"']+)["']""",
    r"""location\.href\s*=\s*["']([^"']+)["']""",
    r"""location\.assign\s*\(\s*["']([^"']+)["']\s*\)""",
    r"""location\.replace\s*\(\s*["']([^"']+)["']\s*\)""",
    r"""fetch\s*\(\s*["']([^"']+)["']\s*\)""",
    r"""\.ajax\s*\(\s*["']([^"']+)["']\s*\)""",
    r"""xhr\.open\s*\(\s*["'][^"']*["']\s*,\s*["']([^"']+)["']\s*\)""",
    r"""url\s*:\s*["']([^"']+)["']""",
    r"""endpoint\s*:\s*["']([^"']+)["']""",
    r"""action\s*:\s*["']([^"']+)["']""",
    r"""path\s*:\s*["']([^"']+)["']""",
    r"""route\s*:\s*["']([^"']+)["']""",
    r"""["'](/[a-zA-Z0-9/_-]+)["']""",
    r"""["']([a-zA-Z0-9][a-zA-Z0-9/_-]*\.(?:html|htm|php|asp|aspx|jsp|py)(?:\?[^"']*)?)["']""",
]
EVENT_ATTRIBUTES = ["onclick", "onload", "onchange", "onsubmit", "ondblclick"]
EVENT_URL_PATTERN = r"""["']([^"']+\.(?:html|htm|php|asp|aspx|jsp)[^"']*)["']"""
CSS_URL_PATTERN = r"""(?i)url\s*\(\s*["']?([^"')]+)["']?\s*\)"""
META_REFRESH_PATTERN = r"(?i)url\s*=\s*([^;]+)"
LINK_TAG_RELATIONS = ["canonical", "next", "prev", "alternate", "related", "author", "help"]
HEADER_LINK_PATTERN = r"""<([^>]+)>\s*;\s*rel\s*=\s*["']?([^"';\s]+)["']?"""
HEADER_RELATIONS = ["next", "prev", "canonical", "alternate", "related"]
URL_PROPERTIES = ["url", "sameAs", "mainEntityOfPage", "image", "logo"]
COMMENT_URL_PATTERN = r"""https?://[^\s<>"]+|/[^\s<>"]*"""
ABSOLUTE_URL_PATTERN = r"""https?://[^\s<>"]+"""

# --- fixed values: page text -------------------------------------------------------------
DESCRIPTION_WORDS = ["flavor", "taste", "blend", "roast", "origin", "notes", "brew", "coffee"]
EXTRACTION_TEXT_LIMIT = 50000
FULL_PAGE_HEADING = "\n\nFULL PAGE CONTENT:\n"

# --- fixed values: JavaScript dependency -------------------------------------------------
NOSCRIPT_PHRASES = [
    "javascript is required", "enable javascript", "this site requires javascript",
    "javascript must be enabled", "turn on javascript", "javascript disabled", "js is disabled",
]
FRAMEWORK_SCRIPT_NAMES = [
    "react.js", "react.min.js", "react.development.js", "react.production.js",
    "vue.js", "vue.min.js", "vue.esm.js",
    "angular.js", "angular.min.js", "@angular/", "ng.js",
    "ember.js", "ember.min.js", "ember.prod.js",
    "svelte.js", "svelte-kit",
    "next.js", "_next/",
    "nuxt.js", "_nuxt/",
    "gatsby-",
]
FRAMEWORK_CODE_MARKS = [
    "React.render", "ReactDOM.render", "React.createElement",
    "new Vue(", "Vue.createApp",
    "angular.module", "ng-app",
]
FRAMEWORK_META_NAMES = ["next-head-count", "nuxt-ssr"]
FRAMEWORK_GENERATOR = "gatsby"
EMPTY_CONTAINER_CLASS = "app|root|container|content"
ROOT_ID = "^(app|root|spa-root|react-root|__next)$"
ROOT_CLASS = r"(^|\s)(app|application|spa-root)(\s|$)"
MAIN_ROOT_ID = "^(app|main-app)$"
LOADING_CLASS_WORDS = ["loading", "spinner", "skeleton", "placeholder", "lazy-load", "shimmer"]
LOADING_TEXTS = ["loading...", "please wait", "fetching data"]
JS_WEIGHTS = {
    "noscript": 40, "minimal_content": 35, "spa_framework": 25, "spa_root": 20, "loading": 15,
    "client_routing": 10, "heavy_js": 8,
}
STATIC_WEIGHTS = {"rich_content": 15, "navigation": 10, "form": 5, "meta_description": 5}
JS_MIN_SCORE = 45
JS_CONSERVATIVE_SCORE = 30
JS_STRICT_EXTRA = 15

# --- fixed values: product records -------------------------------------------------------
MISSING_DESCRIPTION = "Description not available in source content"
SHORT_DESCRIPTION = 20

# --- fixed values: enum domains (catalog spelling) ---------------------------------------
ENUMS = {
    "drink_type": ["espresso", "cold_brew", "latte", "cappuccino", "americano", "filter", "other"],
    "interaction_type": ["view", "click", "add_to_favorites", "purchase", "other"],
    "currency": ["USD", "EUR", "GBP", "CAD", "AUD", "JPY", "CHF", "SEK", "NOK", "DKK", "INR", "other"],
    "roast_level": ["light", "medium_light", "medium", "medium_dark", "dark", "extra_dark", "no_preference"],
    "grind_type": [
        "whole", "extra_coarse", "coarse", "medium_coarse", "medium", "medium_fine", "fine", "extra_fine", "turkish",
    ],
    "brewing_method": [
        "drip_filter", "espresso", "pour_over", "french_press", "cold_brew", "aeropress", "moka_pot", "siphon", "other",
    ],
    "consumption_frequency": ["daily", "several_times_a_week", "once_a_week", "less_than_once_a_week"],
    "flavor_or_caffeine_pref": ["flavor", "caffeine", "either"],
    "flavor_note": ["chocolate_nutty", "fruity_bright", "caramel_sweet", "earthy_spicy"],
    "bean_type": ["arabica", "robusta", "liberica", "excelsa"],
    "budget_range": ["low", "medium", "high"],
    "process": ["natural", "washed", "honey", "pulped_natural", "wet_hulled"],
    "menu_category": [
        "coffee", "tea", "cold_beverage", "hot_beverage", "food", "dessert", "breakfast", "lunch", "snack", "other",
    ],
}

# --- fixed values: spelling variants, lower case -> catalog spelling ----------------------
ROAST_VARIANTS = {
    "light": "light",
    "lite": "light",
    "blonde": "light",
    "cinnamon": "light",
    "medium-light": "medium_light",
    "medium light": "medium_light",
    "city": "medium_light",
    "medium": "medium",
    "med": "medium",
    "city+": "medium",
    "full city": "medium",
    "medium-dark": "medium_dark",
    "medium dark": "medium_dark",
    "full city+": "medium_dark",
    "vienna": "medium_dark",
    "dark": "dark",
    "french": "dark",
    "italian": "dark",
    "espresso": "dark",
}
GRIND_VARIANTS = {
    "whole": "whole",
    "whole bean": "whole",
    "whole beans": "whole",
    "bean": "whole",
    "beans": "whole",
    "ground": "ground",
    "pre-ground": "ground",
    "preground": "ground",
}
PROCESS_VARIANTS = {
    "natural": "natural",
    "dry": "natural",
    "sun-dried": "natural",
    "washed": "washed",
    "wet": "washed",
    "fully washed": "washed",
    "honey": "honey",
    "semi-washed": "honey",
    "pulped natural": "pulped_natural",
    "pulped-natural": "pulped_natural",
    "wet hulled": "wet_hulled",
    "wet-hulled": "wet_hulled",
    "giling basah": "wet_hulled",
}
BEAN_TYPE_VARIANTS = {
    "arabica": "arabica",
    "coffea arabica": "arabica",
    "robusta": "robusta",
    "coffea robusta": "robusta",
    "coffea canephora": "robusta",
    "liberica": "liberica",
    "coffea liberica": "liberica",
    "excelsa": "excelsa",
    "coffea excelsa": "excelsa",
}
BREW_VARIANTS = {
    "espresso": "espresso",
    "drip": "drip_filter",
    "filter": "drip_filter",
    "auto drip": "drip_filter",
    "french press": "french_press",
    "french-press": "french_press",
    "press pot": "french_press",
    "pour over": "pour_over",
    "pour-over": "pour_over",
    "v60": "pour_over",
    "chemex": "pour_over",
    "cold brew": "cold_brew",
    "cold-brew": "cold_brew",
    "aeropress": "aeropress",
    "aero press": "aeropress",
}
