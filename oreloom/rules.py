"""Rule data of the archive-mining operators. Patterns are Java regular expressions for lower-cased, ё-free text."""

from __future__ import annotations

from dataclasses import dataclass, field

WORD = "A-Za-zА-Яа-яЁё0-9"


@dataclass(frozen=True)
class Category:
    """A scored category: 3 for each strong term, 4 for each pattern, 1 for each weak term, -2 for each negative pattern."""

    name: str
    strong: tuple[str, ...]
    weak: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    negative: tuple[str, ...] = ()
    #: Without strong term or pattern, weak terms from this set alone suppress the match or cap it at low.
    lone_weak: tuple[str, ...] = ()
    suppress_lone: bool = False
    #: Strong terms from this set alone, without a pattern and beside this context, cap the match at low.
    lone_strong: tuple[str, ...] = ()
    context: str = ""


STRONG, PATTERN, WEAK, ARTICLE_BONUS, PHOTO_BONUS, NEGATIVE = 3, 4, 1, 2, 1, -2
HIGH_SCORE, MEDIUM_SCORE = 7, 4

# Terms and patterns of the eight categories.
CATEGORIES = (
    Category(
        "flooring",
        strong=("ламинат", "кварцвинил", "кварц винил", "кварц-винил", "керамогранит", "паркет", "инженерная доска", "напольное покрытие", "плитка на пол", "плитка на полу", "плитка для пола", "пол покрасили", "покрытие пола"),
        weak=("пол", "плитка"),
        patterns=(r"плитк[а-яе\s-]{0,30}(пол|полу|пола|наполь)", r"(пол|полу|пола)[а-яе\s-]{0,30}плитк", r"напольн[а-яе\s-]{0,30}(покрыт|материал)", r"\bкварц[\s-]?винил[а-яе]*\b"),
        negative=(r"\bполк[а-яе]*\b", r"\bполоч[а-яе]*\b", r"\bполотенц[а-яе]*\b", r"\bполезн[а-яе]*\b", r"\bполовин[а-яе]*\b", r"\bполу\b"),
        lone_weak=("пол",),
        suppress_lone=True,
    ),
    Category(
        "wall_colors",
        strong=("цвет стен", "стены цвет", "краска", "оттенок краски", "выкрас", "ral", "ncs", "tikkurila", "dulux", "v33", "g482", "g486", "ral 7047", "ral 9016", "30yy", "01yr", "12 gy"),
        weak=("стены", "бежевые стены", "серые стены", "зеленый оттенок"),
        patterns=(r"\bral\s*\d{3,4}\b", r"\bncs\s*[a-z]?\s*\d{4}[a-z\s-]*\b", r"\b\d{2}\s*(yy|yr|gy)\b", r"\bg\d{3}\b"),
    ),
    Category(
        "kitchens",
        strong=("кухня", "кухни", "кухонный гарнитур", "фасад", "фасады", "столешница", "фартук", "мебель ин", "mebel.in", "mebel in", "мебель inn", "кухни москвы", "леруа", "леруа мерлен", "лемана", "hoff", "obi", "оби", "стильные кухни", "дуб каселла", "дуб мадуро", "сантьяго", "ньюпорт"),
        weak=("кухн",),
        patterns=(r"\bкухн[а-яе]*\b", r"\bфасад[а-яе]*\b"),
    ),
    Category(
        "chairs",
        strong=("стулья", "стул", "обеденные стулья", "кухонные стулья", "stoolgroup", "lifemebel", "лайфмебель", "annihaus", "ogogo", "velosso", "sk design"),
        weak=("кресло", "кресла"),
        patterns=(r"\bстул[а-яе]*\b", r"\bстуль[а-яе]*\b"),
    ),
    Category(
        "tables",
        strong=("стол", "столы", "обеденный стол", "кухонный стол", "круглый стол", "журнальный столик", "рабочий стол", "подстолье", "столешница"),
        weak=("столик",),
        patterns=(r"\bстол(ы|а|у|ом|е)?\b", r"\bстолик[а-яе]*\b", r"\bподстоль[а-яе]*\b"),
        lone_strong=("столешница",),
        context=r"\b(кухн[а-яе]*|фасад[а-яе]*|фартук[а-яе]*)\b",
    ),
    Category(
        "sofas",
        strong=("диван", "диваны", "divan.ru", "диван.ру", "moon", "муун", "8 марта", "рогожка", "велюр", "букле", "velvet", "bucle", "soft grey", "velvet emerald", "velvet olive"),
        weak=("софа",),
        patterns=(r"\bдиван[а-яе]*\b", r"\bdivan\.ru\b", r"\bvelvet\s+(emerald|olive)\b"),
    ),
    Category(
        "hallway",
        strong=("прихожая", "в прихожей", "коридор", "шкаф в прихожей", "обувница", "пуф", "банкетка", "зеркало в прихожей", "консоль в прихожей", "входная группа"),
        weak=("шкаф", "зеркало"),
        patterns=(r"\bприхож[а-яе]*\b", r"\bкоридор[а-яе]*\b", r"\bвходн[а-яе\s-]{0,20}групп[а-яе]*\b"),
        lone_weak=("шкаф", "зеркало"),
    ),
    Category(
        "living_room_furniture",
        strong=("гостиная", "тв тумба", "тв-тумба", "тумба под тв", "телевизор", "комод", "стеллаж", "полки", "гостиная мебель", "стенка гостиная", "журнальный столик"),
        weak=("тумба", "шкаф", "полка"),
        patterns=(r"\bтв[\s-]*тумб[а-яе]*\b", r"\bтумб[а-яе\s-]{0,20}(тв|телевизор)", r"\bгостин[а-яе]*\b"),
        lone_weak=("тумба", "шкаф", "полка"),
    ),
)

# What marks a post as an article with purchases. The owner's promo code is a parameter.
ARTICLE_TERMS = ("Артикулы проекта", "Покупки:", "Основные покупки", "Купить все артикулы", "Проект со всеми ссылками", "Проект с большинством ссылок", "OZON Арт.", "WB Арт.", "ВБ арт.", "ЯМ Арт.", "Divan.ru", "Диван.ру", "mebel.in", "мебель ин", "VERESK", "Леруа Мерлен", "Лемана Про", "Сантехника онлайн")
ARTICLE_PATTERNS = (r"\bozon\s*арт\.?", r"\bwb\s*арт\.?", r"\bвб\s*арт\.?", r"\bям\s*арт\.?")

# Vendors in order of precedence, each with its aliases.
VENDORS = (
    ("Divan.ru", (r"official_divan\.ru", r"divan\.ru", r"диван\.ру", r"диван\s*ру")),
    ("Mebel.in", (r"mebel\.in", r"mebel\s*in", r"мебель\s*инн?")),
    ("OZON", (r"ozon(?:\.ru)?", r"озон")),
    ("Wildberries", (r"wildberries(?:\.ru)?", r"wb", r"вб")),
    ("Yandex Market", (r"яндекс[.\s-]*маркет", r"yandex\s*market", r"ям")),
    ("Лемана Про", (r"лемана\s*про",)),
    ("Леруа Мерлен", (r"леруа\s*мерлен", r"леруа(?!\s*мерлен)")),
    ("Сантехника Онлайн", (r"сантехника\s*онлайн", r"santehnika_online")),
    ("VERESK", (r"veresk(?:_mebel)?", r"вереск")),
    ("HOFF", (r"hoff(?:_rus)?", r"хофф")),
    ("Moon", (r"moon(?:\s*trade)?", r"муун")),
)
# Vendors of reports in order of precedence, each with its aliases.
REPORT_VENDORS = (
    ("OZON", (r"ozon", r"озон")),
    ("Wildberries", (r"wildberries", r"wb", r"вб", r"вайлдберриз")),
    ("Yandex Market", (r"yandex market", r"яндекс маркет", r"ям")),
    ("Divan.ru", (r"divan\.ru", r"диван\.ру", r"диван ру", r"official_divan\.ru")),
    ("Mebel.in", (r"mebel\.in", r"mebel in", r"мебель ин", r"мебель inn")),
    ("Лемана Про", (r"лемана про", r"лемана")),
    ("Леруа Мерлен", (r"леруа мерлен", r"леруа")),
    ("Сантехника Онлайн", (r"сантехника онлайн",)),
    ("VERESK", (r"veresk", r"вереск")),
    ("Stoolgroup", (r"stoolgroup", r"stool group")),
    ("Moon", (r"moon", r"муун")),
    ("Alpine Floor", (r"alpine floor",)),
    ("SPC", (r"spc",)),
)
MARKETPLACES = ("OZON", "Wildberries", "Yandex Market")

# Words that begin an item, as whole words.
ITEM_START = r"кухн|фасад|фартук|столешниц|стол|диван|софа|кресл|стул|плитк|керамогранит|кварцвинил|spc|ламинат|паркет|прихож|обувниц|зеркал|вешал|пуф|банкетк|консол|тв\s*тумб|тумб|комод|стеллаж|полк|цвет\s+стен"
LINE_START = r"кухня|фасад|фартук|стол|диван|софа|кресл|стул|плитк|керамогранит|кварцвинил|ламинат|паркет|прихож|обувниц|зеркал|вешал|пуф|банкетк|консол|тв\s*тумб|тумб|комод|стеллаж|полк|цвет\s+стен"

# Keywords behind which an item is described, by extractor, in order.
KEYWORDS = {
    "countertop": ("столешница", "столешницу", "столешницы"),
    "facades": ("кухня фасады", "кухня", "фасады", "фасад"),
    "table": ("журнальный стол", "обеденный стол", "кухонный стол", "рабочий стол", "столешница", "подстолье", "журнальный столик", "столик", "стол"),
    "sofa": ("диван-кровать", "кровать-диван", "диваны", "диван", "софа"),
    "chair": ("рабочее кресло", "кресло", "обеденные стулья", "обеденный стул", "кухонные стулья", "кухонный стул", "стулья", "стул"),
    "flooring": ("плитка на полу", "плитка на пол", "плитка для пола", "керамогранит", "кварцвинил", "кварц винил", "spc ламинат", "ламинат", "паркет"),
    "hallway": ("шкаф", "обувница", "консоль", "пуф", "банкетка", "зеркало", "вешалка", "входная группа"),
    "living_room": ("тв тумба", "тв-тумба", "тумба под тв", "шкаф", "комод", "стеллаж", "полки", "полка", "консоль", "журнальный столик"),
}

# Item heads of a bundle (head, category, forms).
BUNDLE_HEADS = (
    ("кухня", "kitchens", r"кухн(?:я|и|ю|ей)?"),
    ("фасады", "kitchens", r"фасад(?:ы|а|ов)?"),
    ("фартук", "kitchens", r"фартук(?:а|и)?"),
    ("диван", "sofas", r"диван(?:ы|а)?"),
    ("софа", "sofas", r"софа|софы"),
    ("кровать", "sofas", r"кровать(?:-трансформер)?|кровати|кроватью"),
    ("стол", "tables", r"стол(?:ы|а|у|ом|е)?"),
    ("столик", "tables", r"столик(?:и|а|ом|е)?"),
    ("стул", "chairs", r"стул(?:ья|ьев|а|ом|е)?"),
    ("кресло", "chairs", r"кресл(?:о|а|ом|е)?"),
    ("тумба", "living_room_furniture", r"тумб(?:а|ы|у|ой|очка|очки|очку|очкой)?"),
    ("мебель", "living_room_furniture", r"мебел(?:ь|и|ью)?"),
    ("комод", "living_room_furniture", r"комод(?:ы|а|ом|е)?"),
    ("шкаф", "living_room_furniture", r"шкаф(?:ы|а|ом|е|чик|чики|чика|чиком)?"),
    ("стеллаж", "living_room_furniture", r"стеллаж(?:и|а|ом|е)?"),
    ("полка", "living_room_furniture", r"полк(?:а|и|у|ой)?"),
    ("обувница", "hallway", r"обувниц(?:а|ы|у|ей)?"),
    ("консоль", "hallway", r"консол(?:ь|и|ью)?"),
    ("вешалка", "hallway", r"вешалк(?:а|и|у|ой)?"),
    ("пуф", "hallway", r"пуф(?:ы|а|ом|е)?"),
    ("банкетка", "hallway", r"банкетк(?:а|и|у|ой)?"),
    ("зеркало", "hallway", r"зеркал(?:о|а|ом|е)?"),
    ("ковер", "living_room_furniture", r"ков(?:е|ё)р|ковр(?:ы|а|ов|ом|е)?"),
    ("картина", "living_room_furniture", r"картин(?:а|ы|у|ой)?"),
    ("подушка", "living_room_furniture", r"подушк(?:а|и|у|ой)?"),
    ("плед", "living_room_furniture", r"плед(?:ы|а|ом|е)?"),
    ("плитка", "flooring", r"плитк(?:а|и|у|ой)?"),
    ("керамогранит", "flooring", r"керамогранит(?:а|ом|е)?"),
    ("кварцвинил", "flooring", r"кварц[\s-]?винил|кварцвинил(?:а|ом|е)?"),
    ("ламинат", "flooring", r"ламинат(?:а|ом|е)?"),
    ("паркет", "flooring", r"паркет(?:а|ом|е)?"),
)
BUNDLE_WORDS = r"комплект|набор|гарнитур|все\s+для|всё\s+для"
BUNDLE_LIST = r"[,;/]|\s+\+\s+|\s+и\s+"
LIGHTING = r"лампа|светильник|люстра|бра|торшер|подсветка"
DECOR = r"картина|постер|ковер|ковёр|декор|ваза"

# Rooms in order, and those that make a fact of these categories reviewable.
ROOMS = (("bathroom", r"ванн\w*|сануз\w*|душев\w*|туалет\w*"), ("bedroom", r"спальн\w*"), ("kids_room", r"детск\w*"), ("wardrobe", r"гардероб\w*"), ("hallway", r"прихож\w*|коридор\w*"), ("living_room", r"гостин\w*"), ("kitchen", r"кухн\w*"))
NON_TARGET_ROOMS = ("bathroom", "bedroom", "kids_room", "wardrobe")
NON_TARGET_CATEGORIES = ("hallway", "living_room_furniture", "tables", "sofas", "chairs", "kitchens")

# Colour codes, paint brands, materials and colours of a descriptor, and endings that betray a cut word.
COLOR_CODES = (r"\bRAL\s*\d{3,4}\b", r"\bG\d{3}\b", r"\b\d{2}\s*(?:YY|YR|GY)\s*\d{2}/\d{3}\b", r"\bNCS\s*[A-Z]?\s*\d{4}(?:-[A-Z]\d{0,2}[A-Z]?)?\b")
BRANDS = ("Tikkurila", "Dulux", "V33")
MATERIALS = ("velvet", "вельвет", "bucle", "букле", "рогожка", "велюр", "экокожа", "кожа", "шенилл")
COLORS = ("emerald", "olive", "white", "grey", "gray", "green", "red", "blue", "black", "beige", "зеленый", "зеленая", "зеленые", "оливковый", "белый", "серый", "синий", "красный", "черный", "бежевый", "коричневый", "кирпичный")
CUT_WORDS = ("ья", "ье", "ью", "ом", "ик", "ьная", "ого", "ыми", "ая лампа", "ьная лампа")

#: Categories of the strict fact set, in order.
STRICT = ("flooring", "wall_colors", "kitchens", "chairs", "tables", "sofas", "hallway", "living_room_furniture")
CONFIDENCE = {"low": 0, "medium": 1, "high": 2}


@dataclass(frozen=True)
class Neutral:
    """A rule pack for text of any language; used by the registered queries."""

    categories: tuple[Category, ...] = field(default=())


#: A small pack over invented English prose, in patterns that RE2 and Java read alike.
NEUTRAL = Neutral(
    (
        Category("legal", strong=("license", "copyright", "released"), weak=("version", "under"), patterns=(r"licensed? under", r"public license"), negative=(r"worthless",)),
        Category("noise", strong=("worthless", "stupid"), weak=("token", "click"), patterns=(r"[!]{2} ", r"[$]{3}"), negative=(r"license",)),
        Category("article", strong=("the", "that"), weak=("with", "was"), patterns=(r"tion ",), negative=(r"[|]",), lone_weak=("was",), suppress_lone=True),
        Category("function", strong=("of", "and"), weak=("in", "on"), patterns=(r"ing the ",), negative=(r"[#]{3}",), lone_weak=("in", "on")),
    )
)
