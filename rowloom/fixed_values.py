"""Values that have to equal the ones users' existing tables were built with.

Everything here is a fixed value: word lists, lookup tables, patterns, formats,
thresholds and names.  Changing one changes results.
"""

# Words that mean "no value".
BLANK_WORDS = ("nan", "none", "", "null")                   # compared in lower case
BLANK_WORDS_EXACT = ("", "nan", "None", "null", "NaN")      # compared as written

# Boolean vocabularies: the first is compared in lower case, the second as written.
TRUE_WORDS = ("true", "1", "yes", "да", "v")
FALSE_WORDS = ("false", "0", "no", "нет")
TRUE_WORDS_EXACT = ("TRUE", "True", "true", "1", "да", "yes", "Y", "y")
FALSE_WORDS_EXACT = ("FALSE", "False", "false", "0", "нет", "no", "N", "n")

# One trailing currency or unit mark of a number cell.
UNIT_SUFFIX = r"(?i)(руб|руб\.|\$|€|шт|шт\.|[\p{L}\p{N}_]{1,3}\.)$"
# The letters it can end in, in any case (two old forms of т fold to it as well).
UNIT_SUFFIX_ENDS = (".", "$", "€", "б", "Б", "т", "Т", "\u1c84", "\u1c85")

# Column kinds by name: the first two by substring, the last two by whole name.
DATE_KEYWORDS = ("data", "date", "zapis", "den", "dob", "birthday", "created", "updated")
NUMERIC_KEYWORDS = (
    "stoimost", "summa", "kolichestvo", "bonus", "nalichnye", "perevod", "terminal", "vdolg",
    "zp", "oplata", "stavka", "spisano", "god", "mesyats", "chasy", "cena", "skidka", "price",
    "quantity", "amount", "balance", "debt",
)
BOOLEAN_COLUMNS = ("probili_na_evotore", "vnesli_v_crm", "relevant", "zamena", "active", "is_active")
SERVICE_COLUMNS = (
    "source_row_id", "row_hash", "__row_hash", "id", "imported_at", "_row_index", "_loaded_at",
)

# Transliteration of header letters.
TRANSLIT = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z",
    "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r",
    "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh",
    "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
    " ": "_", "-": "_", ".": "", ",": "", "/": "_", "(": "", ")": "",
}

# A header row is recognised by these cells, within the first rows of the sheet.
HEADER_MARKS = ("record_id", "content_hash", "created_at", "updated_at", "updated_by")
HEADER_SCAN_ROWS = 20
FIRST_DATA_ROW = 2           # the header is row 1

# Serial dates: day number of 1970-01-01 when 1899-12-30 is day 0.
SERIAL_UNIX_DAY = 25569

# Date and time shapes a contract may name.
DATE_SHAPES = {
    "DD.MM.YYYY": r"^\d{2}\.\d{2}\.\d{4}$",
    "DD.MM.YY": r"^\d{2}\.\d{2}\.\d{2}$",
    "DD.MM.": r"^\d{2}\.\d{2}\.$",
    "DD.MM": r"^\d{2}\.\d{2}$",
    "YYYY-MM-DD": r"^\d{4}-\d{2}-\d{2}$",
}
TIME_SHAPE = r"^\d{1,2}:\d{2}(:\d{2})?$"
WEEKDAY_PREFIX = r"(?i)^[а-яa-z]{2,3}"
DEFAULT_SCHEDULE_YEAR = 2025
DEFAULT_START, DEFAULT_END = "09:00", "09:30"
EXPORT_TIMESTAMP = "dd.MM.yyyy HH:mm"

# Contracts: (column, type, required, formats).
CONTRACTS = {
    "clients": (
        ("client_full", "string", True, None),
        ("phone_mobile", "string", False, None),
        ("child_name", "string", False, None),
        ("child_birth_date", "date", False, ("DD.MM.YYYY", "DD.MM.YY")),
        ("product_type", "string", False, None),
    ),
    "sales": (
        ("date", "date", True, ("DD.MM.YY", "DD.MM.YYYY", "YYYY-MM-DD")),
        ("client_full", "string", True, None),
        ("product", "string", True, None),
        ("product_type", "string", False, None),
        ("product_category", "string", False, None),
        ("quantity", "integer", False, None),
        ("full_price", "money", False, None),
        ("final_price", "money", False, None),
    ),
    "schedule": (
        ("date", "date", True, ("DD.MM.", "DD.MM", "DD.MM.YY", "DD.MM.YYYY")),
        ("start_time", "time", True, None),
        ("end_time", "time", True, None),
        ("employee", "string", False, None),
        ("client_full", "string", False, None),
        ("status", "string", True, None),
        ("product_type", "string", False, None),
        ("product_category", "string", False, None),
        ("comment", "string", False, None),
    ),
    "expenses": (
        ("date", "date", True, ("DD.MM.YY", "DD.MM.YYYY")),
        ("amount", "money", True, None),
        ("expense_type", "string", False, None),
        ("expense_category", "string", True, None),
        ("contractor", "string", False, None),
        ("description", "string", False, None),
        ("comment", "string", False, None),
        ("category_type", "string", False, None),
    ),
    "price_reference": (
        ("название", "string", True, None),
        ("цена", "money", False, None),
        ("категория", "string", False, None),
        ("тип", "string", False, None),
        ("активен", "boolean", False, None),
    ),
    "rates": (
        ("название", "string", True, None),
        ("ставка", "money", False, None),
        ("категория", "string", False, None),
        ("комментарий", "string", False, None),
    ),
}
UNIQUE_KEYS = {
    "clients": ("client_full", "phone_mobile"),
    "sales": ("date", "client_full", "product", "full_price"),
    "schedule": ("date", "start_time", "client_full"),
    "expenses": ("date", "expense_category", "amount", "description"),
    "price_reference": ("название",),
    "rates": ("название",),
}
CONTRACT_ALIASES = {"trainings": "schedule"}

# Validation messages; {value}, {column} and {formats} are filled in.
MESSAGES = {
    "MISSING_REQUIRED": "Поле {column} обязательно для заполнения",
    "INVALID_INTEGER": "Input should be a valid integer, unable to parse string as an integer",
    "INVALID_MONEY": "Значение '{value}' не является суммой",
    "INVALID_DATE": "Дата '{value}' не соответствует формату {formats}",
    "INVALID_TIME": "Время '{value}' не соответствует формату HH:MM",
}
LOGGED_VALUE_CHARS = 255

# Limits: a load stops above the first two, a report flags above the next two.
MAX_ERRORS, MAX_ERRORS_PER_ROW = 100, 5
REPORT_BAD_ROWS, REPORT_ERROR_RATE = 100, 0.02
SAMPLE_ERRORS, SAMPLE_ISSUES = 5, 10

# Volume anomaly: history length, and the threshold at both ends of the size scale.
HISTORY_RUNS = 5
SMALL_TABLE_ROWS, LARGE_TABLE_ROWS = 100, 10000
SMALL_THRESHOLD, LARGE_THRESHOLD = 0.5, 0.1
CELL_BYTES = 50

# Swap guard, retention and API windows.
MIN_SWAP_RATIO = 0.8
RETENTION_DAYS = 30
API_DAYS = 90
API_RUNS = 10
LOCAL_HOURS = 5
RUN_STATUSES = ("running", "success", "failed")

# Texts of the core tables.
NO_NAME, NO_PHONE, NO_PRODUCT, FREE_SLOT = "Без имени", "+70000000000", "Неизвестно", "Свободно"
USED_STATUSES = ("Посетили", "Пропуск")
# Units of a product, by the first of these that its name contains; otherwise 1.
UNIT_MARKS = (8, 4, 12, 16)
BALANCE_COLUMNS = {
    "name": "Клиент", "phone": "Телефон", "bought": "Куплено", "used": "Использовано",
    "left": "Остаток", "paid": "Оплачено", "status": "Статус", "updated": "Дата обновления",
}
BALANCE_LOW, BALANCE_HIGH = -5, 50

# Seeds of the lookup tables: (name, role or none, aliases).
SEED_EMPLOYEES = (
    ("Система", "admin", ("System", "скрипт")),
    ("Администратор", "admin", ("Админ", "Admin")),
)
SEED_EXPENSE_CATEGORIES = (
    ("Аренда", ("Оплате аренды", "Rent")),
    ("Зарплата", ("ЗП", "Salary")),
    ("Материалы", ("Расходники", "Materials")),
)

# Namespace of name-based ids (the URL namespace of RFC 4122) and the name prefix.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
MESSENGER_PREFIX = "tg:"
MIN_PHONE_CHARS = 5
