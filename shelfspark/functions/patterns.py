"""Fixed values that must equal the reference's for the same results.

Regular expressions, placeholders, selector lists, labels and separators are
stated here plainly, once, in the order the reference uses them.  Java regex
flags are added where they are applied (see ``functions.text.java_flags``),
never baked into these strings.
"""

# --- fixed values: branch-fact classification (JSON-encoded items) ----------
ADDRESS_RE = r"(calle|av\.|avenida|ruta|km|boulevard)"          # case-insensitive
SCHEDULE_RE = r"(lunes|martes|miércoles|jueves|viernes|sábado|domingo|\d{1,2}:\d{2})"  # case-insensitive
PHONE_RE = r"(tel|teléfono|\d{3,4}[-\s]?\d{3,4}[-\s]?\d{3,4})"  # case-insensitive
TIME_RE = r"\d{1,2}:\d{2}"
TIME_RANGE_RE = r"\d{1,2}:\d{2}.*\d{1,2}:\d{2}"
OPEN_EXTRACT_RE = r"(\d{1,2}:\d{2})"
CLOSE_EXTRACT_RE = r"\d{1,2}:\d{2}.*?(\d{1,2}:\d{2})"
FACT_JOIN_SEP = " | "
ADDRESS_SUFFIX = ", Argentina"
SCHEDULE_SEP = " - "

# --- fixed values: store-text model ------------------------------------------
STORE_OPEN_RE = r"(\d{2}:\d{2})"
STORE_CLOSE_RE = r"\d{2}:\d{2}\s+a\s+(\d{2}:\d{2})"
STORE_LINE_SEP = "\n"
STORE_PART_SEP = ","
STORE_ADDRESS_SEP = " , "
STORE_COUNTRY_SUFFIX = " , Argentina"

# --- fixed values: title case word delimiters (besides whitespace) ----------
INITCAP_DELIMITERS = "[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"

# --- fixed values: product name cleaning -------------------------------------
NON_WORD_RE = r"[^\w\s]"

# --- fixed values: page verdict and cards ------------------------------------
INVALID_URL_MARKERS = ["404", "error", "not-found", "pagina-no-encontrada"]
CARD_MARKER = "$"
CARD_MIN_LEN = 10        # valid card: stripped length strictly greater
EVIDENCE_MIN_LEN = 20    # page evidence: stripped length strictly greater
EVIDENCE_FIRST_N = 5     # elements inspected per selector
OPTION_GROUP_MIN = 10    # option list must have more than this many options
PROVINCE_PLACEHOLDER = "Provincia"   # compared case-sensitively
STORE_PLACEHOLDER = "tienda"         # compared case-insensitively
EXTRA_PREFIX = "EXTRA: "

# --- fixed values: per-chain crawl settings ----------------------------------
# chain: (product selectors, no-results selectors, max_empty_pages)
CHAIN_CONFIGS = {
    "CARREFOUR": (
        [".valtech-carrefourar-search-result-3-x-galleryItem",
         'div[class*="galleryItem"]',
         "article"],
        ['text="Sin resultados"',
         'text="No se encontraron productos"',
         'text="No hay productos"',
         'text="Página no encontrada"',
         'text="404"',
         '[class*="titleNotFound"]',
         '[class*="not-found"]',
         '[class*="no-results"]',
         '[class*="empty"]'],
        0),
    "JUMBO": (
        [".jumboargentinaio-cmedia-integration-cencosud-1-x-galleryItem",
         ".vtex-product-summary-2-x-container",
         "article.vtex-product-summary-2-x-element",
         'section[aria-label*="Producto"]'],
        ['text="Sin resultados para tu búsqueda"',
         'text="No se encontraron productos"',
         'text="No hay productos disponibles"',
         'text="Página no encontrada"',
         'text="Error 404"',
         ".vtex-search-result-3-x-notFound",
         ".vtex-search-result-3-x-notFoundOops",
         ".search-not-found-oops",
         ".search-not-found-term",
         ".gallery--empty",
         ".search-result--empty"],
        2),
    "VEA": (
        [".veaargentina-cmedia-integration-cencosud-1-x-galleryItem",
         ".vtex-product-summary-2-x-container",
         "article.vtex-product-summary-2-x-element",
         'section[aria-label*="Producto"]'],
        ['text="Sin resultados para tu búsqueda"',
         'text="No se encontraron productos"',
         'text="No hay productos disponibles"',
         'text="Página no encontrada"',
         'text="Error 404"',
         ".vtex-search-result-3-x-notFound",
         ".vtex-search-result-3-x-notFoundOops",
         ".search-not-found-oops",
         ".search-not-found-term",
         ".gallery--empty",
         ".search-result--empty"],
        0),
}
DEFAULT_MAX_EMPTY_PAGES = 2

# --- fixed values: store-list page and branch detail page --------------------
STORE_LIST_CLASSES = "list ph3 mt0 valtech-carrefourar-store-locator-0-x-addressList"
STORE_ITEM_CLASS = "valtech-carrefourar-store-locator-0-x-addressListItem"
BRANCH_SELECTORS = ["ul li p", "div.store-info, .branch-details, .sucursal-info"]
# --- fixed values: run status -------------------------------------------------
STATE_CLASSES = [("success", "COMPLETED"), ("failed", "FAILED"),
                 ("up_for_retry", "RETRYING"), ("running", "RUNNING")]
STATE_UNKNOWN = "UNKNOWN"
STATE_ERROR = "ERROR"
VERDICT_ALL, VERDICT_PARTIAL, VERDICT_NONE = "ALL", "PARTIAL", "NONE"
# --- fixed values: source labels ----------------------------------------------
SOURCE_STORE_TEXT = "carrefour.com.ar/sucursales"
SOURCE_BRANCHES = "vea.com.ar/sucursales"
PRICE_CATEGORY = "dulce_de_leche"

# --- fixed values: sample price rows (product, price, currency, store,
#     category, url) -----------------------------------------------------------
SAMPLE_PRICES = [
    ("Carne de Res 1kg", 15.50, "ARS", "Carrefour", "Carnes", "https://example.com/carne-res"),
    ("Pollo Entero 1kg", 8.30, "ARS", "Carrefour", "Carnes", "https://example.com/pollo-entero"),
    ("Carne de Res 1kg", 16.20, "ARS", "Coto", "Carnes", "https://example.com/carne-res-coto"),
    ("Pollo Entero 1kg", 7.90, "ARS", "Coto", "Carnes", "https://example.com/pollo-entero-coto"),
]
