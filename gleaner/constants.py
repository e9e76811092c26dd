"""Fixed values.

Word lists, patterns and limits that decide results. They are data, not tuning:
changing one changes which articles are kept. Every list is in its natural order.
"""

# --- character classes shared by all text functions (valid in Java and RE2) ---
# Characters a Unicode-aware strip() removes.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    chr(c) for c in range(0x2000, 0x200B)
) + "\u2028\u2029\u202f\u205f\u3000"
WS = r"[\s\p{Z}\x{b}\x{1c}-\x{1f}\x{85}]"
WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
LINE_BREAK = r"\r\n|[\n\r\x{b}\x{c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"

# RFC 3986 split: scheme, authority, path, query, fragment.
URL_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"

# --- time zones ---
HOME_TZ = "Asia/Tokyo"

# --- general digest (fixed values) ---
ENTRIES_PER_FEED = 15
TOP_PER_MEDIUM = 15
LOOKBACK_HOURS = 24
ITEMS_PER_MEDIUM = 20
ITEMS_TOTAL = 50
TRANSLATION_BATCH = 30

IMPORTANCE_BUCKETS = {
    "鉄鋼": ["steel", "iron", "scrap", "rebar", "H形鋼", "H Beam", "製鉄", "鉄鋼", "高炉", "電炉", "ferrous"],
    "建設": ["construction", "infrastructure", "建設", "ゼネコン"],
    "AI": ["ai", "artificial intelligence", "semiconductor", "半導体", "生成ai", "Data Center", "データセンター"],
    "企業": ["m&a", "買収", "商社", "三菱商事", "住友商事", "伊藤忠商事", "丸紅", "三井物産"],
    "通商": ["trade", "tariff", "sanction", "関税", "AD"],
    "重点国": ["india", "indian", "インド", "vietnam", "ベトナム", "Bangladesh", "バングラデシュ"],
}

NOISE_TERMS = [
    "会社情報", "与信管理", "NIKKEI COMPASS",
    "会社概要", "現状と将来性", "業界の動向",
    "経営・財務", "リスク情報", "企業分析", "基本情報",
    "セミナー", "イベント", "説明会", "講演", "参加者募集",
    "オンライン開催", "受講料", "主催",
    "キャンペーン", "SALE", "セール", "発売", "初売り",
    "無料", "最大", "OFF",
    "新製品", "サービス開始", "提供開始",
    "PR", "提供", "公式", "【", "［",
]

TITLE_SOURCE_NAMES = ["reuters", "bloomberg", "yahoo", "msn", "dメニュー", "ロイター"]
TRANSLATED_MEDIA = ["Kallanish", "BigMint", "Fastmarkets", "Argus", "MySteel", "Reuters", "Bloomberg"]
AGGREGATOR_HOST = "news.google.com"

# --- date rules (fixed values) ---
DATE_RULE_DEFAULTS = {
    "date_source_type": "rss",
    "date_parse_pattern": "",
    "date_css_selector": "",
    "date_timezone": "Asia/Tokyo",
    "date_granularity": "datetime",
    "target_date_mode": "rolling_24h",
    "lookback_hours": 24,
    "fallback_date_source_type": "",
    "fallback_date_parse_pattern": "",
}
DATE_RULE_PRESETS = {
    "日刊鉄鋼新聞": {
        "date_source_type": "article_html",
        "date_css_selector": "time.article-header__published",
        "date_parse_pattern": r"\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}|\d{4}/\d{1,2}/\d{1,2}\s+\d{1,2}:\d{2}",
        "date_granularity": "datetime",
        "target_date_mode": "rolling_24h",
        "date_timezone": "Asia/Tokyo",
    },
    "日刊産業新聞": {
        "date_source_type": "url",
        "date_css_selector": "",
        "date_parse_pattern": r"news-t(\d{4})(\d{2})(\d{2})\d+\.html",
        "date_granularity": "date",
        "target_date_mode": "calendar_day",
        "date_timezone": "Asia/Tokyo",
    },
}
DATE_SOURCE_TYPES = ["rss", "article_html", "meta", "json_ld", "url"]
DATE_GRANULARITIES = ["datetime", "date"]
TARGET_DATE_MODES = ["rolling_24h", "calendar_day"]

# --- issue links (fixed values) ---
EDITION_MARKERS = {"morning": "M", "evening": "E"}
PRE_TITLE_PATTERNS = [
    "野球", "阪神", "広島", "日ハム", "国内女子", "国内男子", "ゴルフ", "大リーグ", "競馬", "天皇賞",
    "欧州CL", "NBA", "J3", "ラグビー", "車いすラグビー", "PO1回戦", "首位スタート", "決勝打", "逆転弾",
    "若冲", "歌人", "小説家", "連載", "澤田瞳子", "江戸を隠してふところに", "はじまりの横浜", "熱国之巻",
    "戦艦大和", "VRでウルトラセブン", "美術館", "絵巻物", "福田美術館", "死去", "悼む", "訃報", "おくやみ",
    r"^\d{1,2}日$", "^市場情報$", "^30日の相場表変更$", "^自社株取得枠設定$",
]
HR_TITLE_PATTERNS = [r".*\s[^\s]{2,6}氏$", r"社長\s.*氏", r"CEOに.*氏"]
SHORT_TITLE_CHARS = 6

# --- rule scoring (fixed values) ---
EXCLUDE_TOPICS = {
    "スポーツ": ["スポーツ", "Jリーグ", "ボクシング"],
    "競馬": ["競馬"],
    "文化": ["文化"],
    "連載小説": ["連載小説"],
    "訃報": ["訃報", "おくやみ"],
    "人事のみ": ["人事"],
    "将棋・囲碁": ["将棋", "囲碁"],
    "芸能": ["芸能", "俳優"],
    "連載コラム": ["コラム"],
}
ONLY_PERSONNEL_TOPIC = "人事のみ"
ONLY_PERSONNEL_REASON = "人事だけの記事"
SCORING_NAV_TERMS = [
    "速報", "アクセスランキング", "トピック一覧", "おくやみ", "プレスリリース", "メディア一覧",
    "ビューアーで読む", "朝刊・夕刊",
]
BOILERPLATE_LINES = [
    "共有", "文字サイズ", "小", "中", "大", "自動翻訳", "英文（システムによる自動翻訳）を表示する",
    "日経の記事利用サービス", "保存", "印刷 翻訳", "検索する", "その他", "［有料会員限定］", "[有料会員限定]",
]
BOILERPLATE_PATTERNS = [
    "朝夕刊や電子版ではお伝えしきれない情報をお届けします。?.*",
    "企業での記事共有や会議資料への転載・複製.*",
    ".*注文印刷.*",
    ".*詳しくはこちら.*",
    r"^\d+文字$",
    r".*javascript:void\(0\).*",
    r"^その他javascript:void\(0\).*$",
]
REPORT_NOISE = [
    "javascript:void(0)", "共有", "文字サイズ", "保存", "印刷", "自動翻訳", "日経の記事利用サービス",
    "Myニュースでまとめ読み", "［有料会員限定］",
]
SAMPLE_REMOVE_PATTERNS = [
    "Myニュースでまとめ読み",
    r"保存\s+共有\s+印刷\s+翻訳\s+その他",
    r"保存\s+共有\s+印刷\s+その他",
    r"保存\s+共有\s+印刷",
    "［有料会員限定］",
    r"\d+文字",
]
RULE_TAG_COLUMNS = {
    "country": "country_tags",
    "sector": "sector_tags",
    "importance": "importance_tags",
    "business_impact": "business_impact_areas",
    "watch_theme": "watch_themes",
}
REASON_EXCLUDED_PREFIX = "除外候補: "
REASON_MATCHED_SUFFIX = "のルールに一致。商社業務への影響確認対象。"

# --- body quality (fixed values) ---
MIN_BODY_CHARS = 120
MIN_SHORT_BODY_CHARS = 40
LOGIN_MARKERS = ["ログイン", "会員登録", "ログインしてください", "日経ID"]
PAID_MARKERS = ["有料会員", "続きは会員限定", "この記事は会員限定", "購読"]
ACCESS_MARKERS = ["Access Denied", "Forbidden", "403", "Bot", "不正なアクセス"]
PAGE_NOISE_MARKERS = ["メニュー", "サイトマップ", "利用規約", "プライバシー", "ページが見つかりません", "エラー"]
LOGIN_PAIR_PATTERN = "(ログイン|会員登録)[^\\n]{0,120}(ログイン|会員登録)"
BODY_NAV_TERMS = [
    "速報", "アクセスランキング", "トピック一覧", "人事", "おくやみ", "プレスリリース",
    "メディア一覧", "NIKKEI Digital Governance", "NIKKEI Financial", "ビューアーで読む",
    "メニュー", "カテゴリ", "一覧",
]
STORE_NAV_TERMS = [
    "速報", "アクセスランキング", "トピック一覧", "人事", "おくやみ", "プレスリリース", "メディア一覧",
    "ビューアーで読む",
]
PARAGRAPH_NAV_TERMS = ["メニュー", "ランキング", "関連記事", "購読", "会員登録", "ログイン", "シェア", "一覧"]
LINK_MARKS = ["http://", "https://", "www.", "▶", "＞", "→"]
SITE_TITLE_SUFFIX = "日本経済新聞"
TITLE_PUNCTUATION = "「」『』【】[]（）()〈〉《》“”\"'・…‥,，、。.!！?？:：;；/／\\|-"
HR_BODY_MARKER = "人事記事をもっと見る"
HR_BODY_WORDS = ["人事", "就任", "社長", "会長", "役員"]
BUSINESS_WORDS = ["M&A", "投資", "決算", "設備投資", "資本提携", "能力増強", "合弁", "買収", "TOB", "インタビュー"]
DISALLOWED_SELECTORS = ['[class*="content"]', "document.body.innerText fallback"]
#: Menus that a page's whole text is rid of.
BODY_MENU = r"メニュー[\s\S]{0,400}?ログイン"
SELECTOR_PREFERENCE = [
    "div.cmn-section.cmn-indent", ".cmn-section", "[data-track-article-body]", '[itemprop="articleBody"]',
    '[class*="article-body"]', '[class*="articleBody"]', "paragraph_fallback", "article", "main",
    '[class*="article"]', '[class*="content"]',
]
BODY_SELECTORS = [
    "div.cmn-section.cmn-indent", "section.cmn-section.cmn-indent", ".cmn-section.cmn-indent", ".cmn-section",
    "[data-track-article-body]", '[itemprop="articleBody"]', '[class*="article-body"]', '[class*="articleBody"]',
    "article", "main", '[class*="article"]', '[class*="content"]',
]
REMOVED_SELECTORS = [
    "header", "footer", "nav", "aside", "script", "style", "noscript", '[role="navigation"]', ".breadcrumb",
    ".breadcrumbs", ".related", ".recommend", '[class*="ranking"]', '[class*="share"]', '[class*="sns"]',
    '[class*="advert"]', '[class*="ad-"]', '[class*="paid"]', '[class*="subscription"]',
]
SAMPLE_SELECTORS = ["div.cmn-section.cmn-indent", ".cmn-section.cmn-indent", ".cmn-section", "article", "main"]

# --- topic scoring (fixed values) ---
TOPIC_WEIGHTS = {
    "総合商社": 18, "鉄鋼": 14, "電炉": 14, "建設": 12, "データセンター": 14, "資源": 13, "エネルギー": 13,
    "為替": 11, "金利": 11, "日銀": 12, "地政学": 10, "M&A": 14, "投資": 10, "物流": 10,
}
TOPIC_COMPANIES = ["三井物産", "三菱商事", "伊藤忠", "住友商事", "丸紅"]
COMPANY_WEIGHT = 12
TOPIC_NEGATIVES = ["スポーツ", "芸能", "レシピ", "占い", "ライフ", "事故"]
NEGATIVE_WEIGHT = 25
NO_TOPIC_REASON = "業務関連キーワードが少ない"
SECTION_KEYWORDS = {
    "経済": ["経済", "macro"],
    "企業": ["企業", "決算", "m&a"],
    "金融": ["金融", "金利", "為替", "日銀"],
    "国際": ["国際", "米国", "中国", "インド", "中東"],
    "産業": ["産業", "鉄鋼", "半導体", "電力", "物流"],
}

# --- store columns (fixed values) ---
STORE_COLUMN_ALIASES = {
    "title": ["Name", "Title", "記事名", "記事タイトル"],
    "url": ["URL", "Url", "url", "Link", "Article URL", "Source URL"],
    "issue": ["Issue Date", "Issued Date", "Published Date"],
    "edition": ["Edition"],
    "source": ["Source", "Media", "媒体"],
    "fetch": ["Fetch Status"],
    "full": ["Full Text Status", "FullText Status", "Body Status", "Extraction Status"],
    "text_len": ["Text Length"],
    "img_count": ["Image Count"],
    "gpt": ["GPT Processed"],
    "has_image": ["Has Image"],
    "has_chart": ["Has Chart"],
    "img_url": ["Image URL"],
    "img_cap": ["Image Caption"],
    "body": ["Body", "Article Body", "Article Text", "Text", "Content", "本文", "記事本文"],
    "summary": ["Summary", "要約", "AI Summary"],
}
REQUIRED_REPORT_COLUMNS = ["Title", "Date"]
BODY_START_HEADINGS = ["記事本文", "タイトル", "本文"]
BODY_STOP_HEADINGS = ["メタデータ"]
BODY_HEADING = "本文"
TITLE_HEADING = "タイトル"
MAX_BLOCKS = 100
CHUNK_CHARS = 1800
TEXT_CHARS = 1900
LONG_TEXT_CHARS = 2000
TAG_CHARS = 100

# --- report texts (fixed values) ---
SECTION_DEFAULT_SUMMARY = "記事要点を整理中です。"
SECTION_DEFAULT_WHY = "記事の変化が需給・投資・価格にどう波及するかを読む意義があります。"
SECTION_DEFAULT_ACTION = "案件前提、取引先の投資姿勢、関連コストの動きを並べて把握したい内容です。"
SECTION_DEFAULT_FACT = "記事本文の要点を整理しています。"
SECTION_DEFAULT_IMPLICATION = "商社としては、需要見通し、取引先の投資姿勢、関連コストへの波及を見ておきたい内容です。"
SECTION_DEFAULT_OUTLOOK = "取引先・投資先・調達先への影響を分けて読むと、案件前提の変化を把握しやすくなります。"
HEADLINE_PREFIX = "変化"
HEADLINE_SEPARATORS = ["：", ":", "。", "、"]
REQUIRED_REPORT_TEXTS = ["report_title", "executive_summary", "today_key_message", "cross_article_implications"]
REQUIRED_REPORT_KEYS = ["integrated_insights", "watchlist"]
