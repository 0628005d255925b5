"""Word lists, tables and patterns that results depend on. They are data, stated plainly, with no logic."""

from __future__ import annotations

# Months, as nominative and genitive words.
MONTHS = {
    "январь": 1, "января": 1, "февраль": 2, "февраля": 2, "март": 3, "марта": 3, "апрель": 4, "апреля": 4, "май": 5, "мая": 5, "июнь": 6, "июня": 6,
    "июль": 7, "июля": 7, "август": 8, "августа": 8, "сентябрь": 9, "сентября": 9, "октябрь": 10, "октября": 10, "ноябрь": 11, "ноября": 11, "декабрь": 12, "декабря": 12,
}
ENGLISH_MONTHS = {
    "january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12,
}
MONTH_NAMES = ["Январь", "Февраль", "Март", "Апрель", "Май", "Июнь", "Июль", "Август", "Сентябрь", "Октябрь", "Ноябрь", "Декабрь"]
MONTH_GENITIVES = ["января", "февраля", "марта", "апреля", "мая", "июня", "июля", "августа", "сентября", "октября", "ноября", "декабря"]

# Transliteration.
TRANSLITERATION = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p",
    "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}

# Document types and their labels.
TYPE_LABELS = {
    "dictation": "Диктовка", "lecture": "Лекция", "lectureCourse": "Курс лекций", "teaching": "Учения", "sermon": "Проповедь", "prayer": "Молитва", "material": "Материал",
}

# Roman numerals of parts.
ROMAN = {"1": "I", "2": "II", "3": "III", "4": "IV", "5": "V", "6": "VI", "7": "VII", "8": "VIII", "9": "IX", "10": "X"}

# Patterns of lines (ECMAScript syntax, case-insensitive unless a name ends in _CASED).
HEADING_WORDS = r"Диктовка|Лекция|Лекции|Курс\s+лекций|Семинар|Учения|Проповедь"
HEADING = rf"^({HEADING_WORDS})(?:\s|$)"
PLAIN_HEADINGS = [
    r"^Воскресная\s+проповедь$",
    r"^Лекция\s+(?:Э\.?\s*К\.?\s*Профет|Элизабет\s+Клэр\s+Профет)$",
    r"^Лекции\s+(?:Э\.?\s*К\.?\s*Профет|Элизабет\s+Клэр\s+Профет|Марк[аом]?\s+Л\.?\s+Профет[аом]?)$",
]
ATTRIBUTION = (
    r"^(Диктовка|Лекция|Лекции|Курс\s+лекций|Учения|Проповедь)\s+.+\s+"
    r"(была|был|были|дана|дан|даны|передана|передан|переданы|прочитана|прочитан|прочитаны|через)(?:\s|$)"
)
AUTHOR_ONLY = r"^(?:Марк[аом]?\s+Л\.?\s+Профет[аом]?|Э\.?\s*К\.?\s*Профет|Элизабет\s+Клэр\s+Профет)$"
SERIES = r"Жемчужин[аыеуой]+\s+Мудрости"
SERIES_TITLE = "Жемчужины Мудрости"
RUNNING_CASED = r"^[А-ЯЁа-яё]+\s+(?:19|20)\d{2}$"
PUBLICATION = r"^Том\.?\s+\d+\s*,?\s*№"
VOLUME = r"^Том\.?\s+(\d+)"
ISSUE = r"№+\s*([\d,\s]+)"
ISSUE_DATE_CASED = r"(\d{1,2}(?:\s*,\s*\d{1,2})?\s+[А-ЯЁа-яё]+\s+(?:19|20)\d{2}\s*г?\.?)"
PAGE_NUMBER = r"^\d+$"
PART_LINE = r"^\(?часть\s+([IVXLCDM\d\s]+)\)?$"
PART_ONLY = r"^Часть\s+[IVXLCDM\d]+$"
INVOCATION = r"^ПРИЗЫВ(?![\p{L}\p{N}])"
NOT_TITLES = [r"^через\s+", INVOCATION, r"^Призыв\s+Посланника:?$", r"^\*+$", r"\(?избранные\s+учения\)?", r",$"]
NOT_LEADS = [r"^Благословение:?$", r"^Молитва:?$"]
GENERIC = [INVOCATION, r"^Призыв\s+Посланника:?$", r"^Воскресная\s+проповедь$"]
RETREAT = r"ретрит"
QUOTED = r"[«\"]([^»\"]+)[»\"]"
TYPED_LINE = r"(диктовка|лекция|курс\s+лекций|семинар|учения|проповедь)"
MESSENGERS = [("Элизабет Клэр Профет", r"Элизабет\s+Клэр\s+Профет"), ("Марк Л. Профет", r"Марк[аом]?\s+Л\.?\s+Профет[аом]?")]
CANONICAL_AUTHORS = [("Марк Л. Профет", r"(Марк[аом]?|Марком)\s+Л\.?\s+Профет[аом]?"), ("Элизабет Клэр Профет", r"(Э\.?\s*К\.?\s*Профет|Элизабет\s+Клэр\s+Профет)")]
NORMAL_AUTHORS = [
    ("Элизабет Клэр Профет", r"^[эе]\.?\s*к\.?\s*профет(?:\s|$)|^элизабет\s+клэр\s+профет(?:\s|$)|^возлюбленный посланник$|^посланник$"),
    ("Марк Л. Профет", r"^марка\s+л\.?\s+профет[а]?$|^марк\s+л\.?\s+профет$"),
]
TITLED_NAMES = r"(?:Профет|Владык|Архангел|Элохим|Будд)"
HOLY_NAMES = r"(?:Профет|Владык|Архангел|Элохим|Будд|Господ|Бог|Богиня)"
HOLY_NAMES_OR_MESSENGER = r"(?:Профет|Владык|Архангел|Элохим|Будд|Господ|Бог|Богиня|Посланник)"
FILE_AUTHOR = r"(?:Диктовка|Лекция|Лекции|Курс\s+лекций|Семинар|Учения|Проповедь)\s+([^'_]+?)(?:\s+['\"]|$)"
AUTHOR_STRIPS = [
    (r"^(Диктовка|Лекция|Лекции|Курс\s+лекций|Семинар|Проповедь)[-\s]*", ""),
    (r"(была|был|даны|дана|дан|через|Посланника|прочитана|прочитан).*$", ""),
    (r"\s+[«\"].*$", ""),
    (r"[«»\"]", ""),
]
NOMINATIVES = [
    (r"^(?iu:возлюбленн(?:ый|ая|ого|ую))\s+", ""), (r"^Вознесенной\s+Владычицы\s+Нады(?=\s|$)", "Вознесенная Владычица Нада"), (r"^Эль\s+Мории(?=\s|$)", "Эль Мория"),
    (r"^Сурии\s+и\s+Куско(?=\s|$)", "Сурия и Куско"), (r"^Богини(?=\s|$)", "Богиня"), (r"^Бога\s+Гармонии(?=\s|$)", "Бог Гармония"), (r"^Архангела\s+Иофиила(?=\s|$)", "Архангел Иофиил"),
    (r"^Сераписа\s+Бея(?=\s|$)", "Серапис Бей"), (r"^Господа\s+Майтрейи(?=\s|$)", "Господь Майтрейя"), (r"^Архангела\s+Михаила(?=\s|$)", "Архангел Михаил"),
]
DISPLAY_NAMES = [
    (r"^Господа Майтрейи$", "Господь Майтрейя"), (r"^Архангела Михаила$", "Архангел Михаил"), (r"^возлюбленного Гелиоса$", "Возлюбленный Гелиос"), (r"^возлюбленный", "Возлюбленный"),
]
TITLE_LEADS = r"^(Проповедь|Лекция|Курс\s+лекций|Семинар|Учения|Диктовка)\s+"
BODY_MARKERS = [r"^(открывающий\s+)?призыв$", INVOCATION, r"^через\s+", r"^молитва$", r"^преамбула$"]
NOISE = [r"^\(?избранные\s+учения\)?$", r"^\*+$", SERIES]
ANALYSIS_NOISE = [r"^[\"«]?\(?избранные\s+учения\)?[\"»]?$", r"^\*+$", SERIES]
WEAK = [r"^Сегодня(?![\p{L}\p{N}])", r",$", r"^\(?\s*часть\s+[IVXLCDM\d\s]+\)?$"]
GENERIC_ATTRIBUTION = r"^(Лекция|Проповедь|Диктовка)\s+(?:Марка?\s+Л\.?\s+Профета?|Э\.?\s*К\.?\s*Профет|Элизабет\s+Клэр\s+Профет)$"
COURSE_LINE = r"^(Курс\s+лекций|Семинар|Учени[ея])(?:\s|$)"
AUTHOR_IN_TITLE = [r"Э\.?\s*К\.?\s*Профет", r"Элизабет\s+Клэр\s+Профет"]
MARK_IN_TITLE = [r"(?<![\p{L}\p{N}])Марка\s+Л\.?\s+Профета(?![\p{L}\p{N}])", r"(?<![\p{L}\p{N}])Марк\s+Л\.?\s+Профет(?![\p{L}\p{N}])"]

# Archive layout.
FORMATS = ["word", "pdf-mailing", "pdf-print", "originals"]
WORD_DIRS = ["word", "брошюры", "брошюра"]
MAILING_DIR, MAILING_PREFIX = "pdf-mailing", "рассылка"
PRINT_DIRS = ["pdf-print", "печать"]
CANONICAL_STEM = r"^(?:19|20)\d{2}Q[1-4]-[1-3]$"
SKIPPED_NAMES = [".git", ".DS_Store", "README.md", "source-audit.json", "source-map.json"]
EXPORT_FORMATS = ["pdf", "txt", "docx", "epub"]

# Paths of pages, of stored sources and of their legacy directory.
PAGE_PATH = "/pearls/"
STORED_PREFIX, LEGACY_PREFIX, LEGACY_SEGMENT = "data/source-data/", "data/source-data/pearls-word/", "/pearls-word/"
