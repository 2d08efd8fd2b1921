"""Landed articles, accounts and threat-intelligence objects."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kenning.operators.graph import connected_components
from kenning.operators.records import account_name
from kenning.plans.store import materialise

# What an account's articles are scored by. Points of words, marks of reposts, technical terms.
KEYWORDS = {
    5: ["渗透测试", "红队", "漏洞挖掘", "代码审计", "内网渗透", "漏洞利用", "exploit", "payload", "webshell", "RCE", "Active Directory", "Kerberos", "横向移动", "持久化", "BypassAV", "免杀", "提权", "权限维持"],
    2: ["安全", "CTF", "Writeup", "靶场", "漏洞", "vulnerability", "C2", "CobaltStrike", "Metasploit", "mimikatz", "SQL注入", "XSS", "SSRF", "XXE", "CSRF", "命令注入", "反序列化", "文件包含", "目录遍历", "越权"],
    1: ["CVE", "POC", "EXP", "零日", "0day", "威胁情报", "应急响应", "APT", "供应链", "沙盒逃逸"],
}
REPOSTS = ["转载", "来源：", "来源:", "原文链接", "原文地址", "作者：", "作者:", "首发于", "本文来自"]
TERMS = [
    "payload", "exploit", "poc", "exp", "rce", "sql", "xss", "ssrf", "ldap", "ntlm", "kerberos", "mimikatz", "cobalt", "metasploit", "reverse shell", "bind shell", "c2", "c&c", "bypass", "webshell",
    "privilege", "escalation", "lateral movement", "persistence", "渗透", "漏洞", "代码审计", "内网", "提权", "后门",
]
IDENTITY_KEYS = ["__biz", "mid", "idx", "sn"]


def standardise(articles: DataFrame) -> DataFrame:
    """The seven canonical columns, whatever the source's spelling, plus the rest as it is."""
    spelled = {"title": ["title", "name"], "link": ["link", "url"], "date": ["date", "publish_time", "published"], "summary": ["summary", "description", "content"], "type": ["type"], "site": ["site", "source"], "scraped_time": ["scraped_time"]}
    chosen = [F.coalesce(*[F.col(f"`{c}`").cast("string") for c in names if c in articles.columns], F.lit("")).alias(out) for out, names in spelled.items()]
    used = {c for names in spelled.values() for c in names}
    return articles.select(*chosen, *[c for c in articles.columns if c not in used])


def valid(articles: DataFrame) -> DataFrame:
    return articles.filter("title <> '' AND link <> '' AND summary <> ''")


def first_by(rows: DataFrame, keys: list[str], order: list[str], keep_blank: bool = False) -> DataFrame:
    """The first row of each key; rows with a blank key are kept or dropped."""
    blank = F.coalesce(*[F.nullif(F.col(k).cast("string"), F.lit("")) for k in keys]).isNull()
    w = Window.partitionBy(*keys).orderBy(*order)
    numbered = rows.withColumn("__n", F.row_number().over(w))
    keep = (F.col("__n") == 1) & ~blank
    return numbered.filter(keep | blank if keep_blank else keep).drop("__n")


def url_identity(url: Column) -> Column:
    """The identifying query keys if all are there, else the URL without its query and fragment."""
    parts = [F.regexp_extract(url, rf"[?&]{k}=([^&#]*)", 1) for k in IDENTITY_KEYS]
    whole = F.lit(True)
    for p in parts:
        whole = whole & (p != "")
    return F.when(whole, F.concat_ws("|", *parts)).otherwise(F.regexp_replace(url, r"[?#].*$", ""))


def completeness(title: Column, link: Column, body: Column) -> Column:
    """0 to 1: title, link, body at three lengths, code."""
    terms = [(F.coalesce(title, F.lit("")) != "", 0.2), (F.coalesce(link, F.lit("")).startswith("http"), 0.2), (F.length(body) > 0, 0.1), (F.length(body) >= 500, 0.2), (F.length(body) >= 2000, 0.2), (F.coalesce(body, F.lit("")).rlike("```|<code|<pre"), 0.1)]
    return F.round(sum((F.when(c, w).otherwise(0.0) for c, w in terms), F.lit(0.0)), 6)


def count_of(text: Column, needle: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)


def account_scores(articles: DataFrame) -> DataFrame:
    """Per account: relevance .40, activity .20, originality .25, depth .15, total and grade.

    Rows: account, title, content, age_days (null if unknown).
    """
    text = F.lower(F.concat_ws(" ", "title", "content"))
    hits = sum((F.when(text.contains(k.lower()), w).otherwise(0) for w, words in KEYWORDS.items() for k in words), F.lit(0))
    content = F.coalesce("content", F.lit(""))
    original = ~F.substring(content, 1, 200).rlike("|".join(REPOSTS))
    code = F.least(F.floor(count_of(content, "```") / 2) * 15.0, F.lit(45.0))
    size = F.least(F.greatest(F.lit(0.0), (F.length(content) - 500) / 1500 * 30.0), F.lit(30.0))
    terms = sum((F.when(F.lower(content).contains(t), 1).otherwise(0) for t in TERMS), F.lit(0))
    density = F.least(terms / F.greatest(F.length(content) / 1000, F.lit(1.0)) * 5.0, F.lit(25.0))
    grouped = articles.groupBy("account").agg(
        F.count(F.lit(1)).alias("n"),
        F.least(F.avg(F.least(hits.cast("double"), F.lit(10.0))) * 10, F.lit(100.0)).alias("relevance"),
        F.when(F.count("age_days") == 0, 50.0)
        .otherwise(0.6 * F.greatest(F.lit(0.0), 100.0 - 2 * F.min("age_days")) + 0.4 * F.least(F.sum((F.col("age_days") <= 30).cast("int")) * 10.0, F.lit(100.0)))
        .alias("activity"),
        (F.avg(original.cast("double")) * 100).alias("originality"),
        F.least(F.avg(code + size + density), F.lit(100.0)).alias("depth"),
    )
    total = F.round(0.40 * F.col("relevance") + 0.20 * F.col("activity") + 0.25 * F.col("originality") + 0.15 * F.col("depth"), 4)
    return grouped.withColumn("total", total).withColumn("grade", grade(F.col("total")))


def grade(total: Column) -> Column:
    return F.when(total >= 75, "A").when(total >= 50, "B").when(total >= 30, "C").otherwise("D")


def score_gate(total: Column) -> Column:
    return F.when(total >= 40, "auto").when(total >= 25, "review").otherwise("drop")


def merge_candidates(channels: DataFrame) -> DataFrame:
    """Candidates by name with their sources joined in order of first appearance: name, source, ord."""
    per = channels.groupBy("name", "source").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("ord", "source")))
    return per.groupBy("name").agg(F.min("ord").alias("first"), F.array_join(F.transform(ordered, lambda x: x["source"]), "+").alias("sources"), F.sum("n").alias("n"))


# Words that speak for a candidate (the first group that fits adds its points once), and trust by source.
NAME_WORDS = [
    (15, ["渗透", "红队", "漏洞", "代码审计", "内网", "security", "安全"]),
    (8, ["ctf", "逆向", "二进制", "应急", "exploit", "web安全"]),
    (3, ["研究", "实验室", "cert", "response", "预警"]),
]
SOURCE_TRUST = {"community_regex": 18, "community_llm": 20, "citation": 10, "citation_biz": 12, "sogou_account_search": 5, "sogou_article_search": 3}
CHANNELS = ["sogou", "citation", "community"]


def quick_score(name: Column, source: Column, description: Column) -> Column:
    """Score of a candidate before any of its articles is read: words of its name, its source, a description."""
    low, total = F.lower(F.coalesce(name, F.lit(""))), F.lit(0)
    for points, words in NAME_WORDS:
        total = total + F.when(low.rlike("|".join(words)), points).otherwise(0)
    for known, points in SOURCE_TRUST.items():
        total = total + F.when(source == known, points).otherwise(0)
    return F.least(total + F.when(F.length(description) > 20, 5).otherwise(0), F.lit(100)).cast("double")


def first_channel(candidates: DataFrame) -> DataFrame:
    """One row per biz, or per name without one: that of the first channel in CHANNELS, by ord within it."""
    key = F.coalesce(F.nullif(F.trim("biz"), F.lit("")), F.col("name"))
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(c) for c in CHANNELS]), F.col("channel")), F.lit(0)), F.lit(len(CHANNELS) + 1))
    keyed = candidates.withColumns({"__key": key, "__rank": rank})
    return first_by(keyed, ["__key"], ["__rank", "ord"]).drop("__key", "__rank")


def new_only(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows none of whose keys was seen before (each key on its own)."""
    out = rows
    for k in keys:
        out = out.join(seen.select(k).distinct(), k, "left_anti")
    return out


# Objects of a STIX bundle: rows of (id, type, name, obj JSON).


def stix_objects(bundles: DataFrame, column: str = "value") -> DataFrame:
    """id, type, name, external_id, external_url, obj of every object of the bundles (JSON text)."""
    ref = "struct<source_name:string,external_id:string,url:string>"
    schema = f"struct<objects:array<struct<id:string,type:string,name:string,source_ref:string,target_ref:string,relationship_type:string,external_references:array<{ref}>,kill_chain_phases:array<struct<kill_chain_name:string,phase_name:string>>>>>"
    objects = bundles.select(F.explode(F.from_json(column, schema)["objects"]).alias("o")).select("o.*")
    first = F.get(F.filter("external_references", lambda r: r["source_name"] == "mitre-attack"), F.lit(0))
    return objects.withColumns({"external_id": first["external_id"], "external_url": first["url"], "tactics": F.transform("kill_chain_phases", lambda p: p["phase_name"])})


def stix_type(objects: DataFrame, kind: str) -> DataFrame:
    return objects.filter((F.col("type") == kind) & F.col("external_id").isNotNull())


def related(relations: DataFrame, objects: DataFrame, kind: str) -> DataFrame:
    """source name, target name by one relation: two inner joins."""
    s = objects.select(F.col("id").alias("source_ref"), F.col("name").alias("source_name"), F.col("type").alias("source_type"))
    t = objects.select(F.col("id").alias("target_ref"), F.col("name").alias("target_name"), F.col("type").alias("target_type"))
    return relations.filter(F.col("relationship_type") == kind).select("source_ref", "target_ref").join(s, "source_ref").join(t, "target_ref")


# What makes an article worth keeping: patterns, hints, and words of advertising in titles and texts.
STRONG = [
    r"cve-\d{4}-\d{4,7}", r"漏洞|漏洞复现|漏洞分析|利用链|补丁分析", r"远程代码执行|任意代码执行|命令执行|提权|越权|越界|目录遍历|反序列化", r"sql注入|xss|ssrf|xxe|rce|lfi|rfi|ssti",
    r"poc\b|\bexp\b|exploit|payload|getshell|shellcode", r"渗透测试|内网渗透|横向移动|红队|蓝队|应急响应|威胁狩猎",
]
HINTS = [
    "渗透", "漏洞", "利用", "提权", "内网", "绕过", "web安全", "0day", "0-day", "cnnvd", "cnvd", "高危漏洞", "严重漏洞", "威胁情报", "恶意软件", "勒索", "木马",
    "后门", "apt", "c2", "ctf", "逆向", "二进制", "代码审计", "nmap", "burp", "metasploit", "mimikatz", "sqlmap", "免杀", "攻击链", "复盘", "通告", "预警",
]
NOISE_TITLE = ["战略合作", "签署合作", "达成合作", "签约仪式", "发布会", "峰会", "论坛", "大会", "研讨会", "招聘", "校招", "内推", "获奖", "荣誉", "周年", "生态合作", "联合声明", "活动报名", "直播预告", "课程报名", "产品发布", "品牌升级"]
NOISE_TEXT = ["签署战略合作协议", "双方经营班子成员", "出席并见证签约仪式", "市场需求的迎合", "业务团队代表", "合作伙伴", "品牌影响力", "市场拓展", "生态共建"]
LEAST_CHARS = 260
# What names are compared without, and endings that don't tell accounts apart.
NAME_SPACE, NAME_MARKS = r"[\s\u3000]+", r"[·•,，.。:：;；\-_/\\|()（）\[\]{}<>《》【】\"'“”‘’`~!！?？]"
NAME_ENDS = r"(官方公众号|公众号|官方|研究院|研究中心|实验室|安全实验室|安全研究院)$"
# Ways in which a text names its source, most exact first; a link's account; words that are no names.
SOURCES = [
    r"转载[自来源于来自于]?\s*[【「\[]([^】」\]]{2,25})[】」\]]", r"来源[：:]\s*([^\s，,。\n【】「」]{2,25})", r"作者\s*[|｜]\s*([^\s，,。\n【】「」]{2,25})", r"(?:推荐关注|关注公众号|扫码关注)\s*[「【\[]([^」】\]]{2,25})[」】\]]",
    r"首发[于:]?\s*([^\s，,。\n【】「」]{2,25})", r"本文(?:来自|转自|摘自|首发于|出处)\s*[：:]?\s*([^\s，,。\n【】「」]{2,25})", r"版权归\s*([^\s，,。\n【】「」]{2,20})\s*所有",
]
BIZ = r"mp\.weixin\.qq\.com/s[?/][^\"'>\s]*[?&]__biz=([A-Za-z0-9=+/]{10,})"
NO_NAMES = [
    "微信", "朋友圈", "公众号", "关注", "原文", "作者", "编辑", "转载", "来源", "版权", "声明", "本文", "文章", "链接", "网络", "互联网", "以上", "以下", "前者", "后者", "此处", "该文", "相关", "更多",
    "点击", "阅读", "扫描", "扫码", "二维码", "联系", "合作", "投稿", "平台", "渠道", "官方", "账号", "号主", "小编", "原作者", "原作", "编译", "整理", "责编", "排版", "审核", "摘要", "全文", "部分", "关键词", "参考", "引用", "致谢",
]


def plain_name(name: Column) -> Column:
    """Lower case without spaces and punctuation."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), NAME_SPACE, ""), NAME_MARKS, "")


def _says(low: Column, pattern: str) -> Column:
    """Whether a text in lower case holds one of the pattern's alternatives; only those that are no plain words, where their word is found, are matched."""
    out = F.lit(False)
    for part in pattern.split("|"):
        word = re.sub(r"\\d.*|\\b", "", part)
        out = out | (low.contains(word) if word == part else low.contains(word) & low.rlike(part))
    return out


def relevant(title: Column, body: Column) -> Column:
    """Whether an article has technical worth.

    Long enough; not an advertisement (words of one in the title and few signs against it, or two in the text and fewer);
    then a pattern in the title, or one anywhere and two hints, or six hints.
    """
    head, text = F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))
    total = lambda flags: sum((f.cast("int") for f in flags), F.lit(0))
    # Over an array of one, so that plain texts and counts are made once a row and not at each use.
    once = lambda value, of: F.get(F.transform(F.array(value), of), F.lit(0))
    given = F.struct(text.alias("text"), F.lower(F.concat_ws("\n", head, text)).alias("whole"), F.lower(head).alias("low_head"), F.concat_ws("\n", plain_name(head), plain_name(text)).alias("plain"), plain_name(head).alias("plain_head"))
    counts = once(
        given,
        lambda x: F.struct(
            total(_says(x["whole"], p) for p in STRONG).alias("strong"), total(_says(x["low_head"], p) for p in STRONG).alias("in_title"), total(x["plain"].contains(h) for h in HINTS).alias("hints"),
            total(x["plain_head"].contains(w) for w in NOISE_TITLE).alias("adverts"), total(x["text"].contains(w) for w in NOISE_TEXT).alias("trade"), F.length(x["text"]).alias("chars"),
        ),
    )

    def verdict(n: Column) -> Column:
        advertised = (n["adverts"] > 0) & (n["in_title"] == 0) & (n["hints"] < 3)
        business = (n["trade"] >= 2) & (n["strong"] == 0) & (n["hints"] < 4)
        return (n["chars"] >= LEAST_CHARS) & ~advertised & ~business & ((n["in_title"] > 0) | ((n["strong"] > 0) & (n["hints"] >= 2)) | (n["hints"] >= 6))

    return once(counts, verdict)


def core_name(name: Column) -> Column:
    """The plain name without an ending that doesn't tell accounts apart."""
    return F.regexp_replace(plain_name(name), NAME_ENDS, "")


def same_name(actual: Column, target: Column) -> Column:
    """Whether an account's name is the one that was looked for: equal as plain or core names, or one core of three
    characters or more inside the other. An unknown name passes."""
    x, y, a, b = plain_name(actual), plain_name(target), core_name(actual), core_name(target)
    inside = (F.least(F.length(a), F.length(b)) >= 3) & (a.contains(b) | b.contains(a))
    return (x == "") | (x == y) | ((a != "") & (a == b)) | inside


#: Characters of the pieces by which contained names are found.
GRAM = 3


def rekeyed(names: DataFrame) -> DataFrame:
    """name, account, n: accounts that go by several names, under the name most of their articles have (then the shortest).

    names: name, n. Two names are one account if same_name() holds, through others if need be. A name that lies in
    another shares all its pieces of three characters with it, so it is looked up by the rarest of them only; no pairs of
    names are tried out.
    """
    cores = materialise(names.filter(plain_name(F.col("name")) != "").groupBy("name").agg(F.sum("n").alias("n")).withColumn("core", core_name(F.col("name"))), "names")
    keys = cores.select(F.coalesce(F.nullif("core", F.lit("")), F.concat(F.lit("="), plain_name(F.col("name")))).alias("core")).distinct()
    spots = F.when(F.length("core") >= GRAM, F.sequence(F.lit(1), F.length("core") - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    pieces = materialise(keys.filter(~F.col("core").startswith("=")).select("core", F.explode(F.array_distinct(F.transform(spots, lambda i: F.substr("core", i, F.lit(GRAM))))).alias("piece")), "pieces")
    held = pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("held"))
    rarest = pieces.join(held, "piece").groupBy("core").agg(F.min(F.struct("held", "piece")).alias("r")).select(F.col("core").alias("inner"), F.col("r.piece").alias("piece"))
    inside = pieces.join(rarest, "piece").filter((F.col("core") != F.col("inner")) & F.col("core").contains(F.col("inner")))
    root = connected_components(inside.select(F.xxhash64("core").alias("a"), F.xxhash64("inner").alias("b")))
    keyed = cores.withColumn("key", F.xxhash64(F.coalesce(F.nullif("core", F.lit("")), F.concat(F.lit("="), plain_name(F.col("name"))))))
    joined = keyed.join(root, keyed["key"] == root["node"], "left").withColumn("root", F.coalesce("root", "key"))
    best = joined.groupBy("root").agg(F.min_by("name", F.struct(-F.col("n"), F.length("name"), "name")).alias("account"))
    return joined.join(best, "root").select("name", "account", "n")


def citations(articles: DataFrame, id_col: str = "id", text_col: str = "text", author_col: str | None = None) -> DataFrame:
    """id, name, source (citation or citation_biz), n: the accounts that a text names as its source, but its author.

    A link's account is named `__biz:` and its key.
    """
    bare = lambda x: F.regexp_replace(F.trim(x), r"[。，！？…\]）』]+$", "")
    named = F.transform(F.concat(*[F.regexp_extract_all(F.col(text_col), F.lit(p), F.lit(1)) for p in SOURCES]), lambda x: F.struct(bare(x).alias("name"), F.lit("citation").alias("source")))
    linked = F.transform(F.regexp_extract_all(F.col(text_col), F.lit(BIZ), F.lit(1)), lambda x: F.struct(F.concat(F.lit("__biz:"), x).alias("name"), F.lit("citation_biz").alias("source")))
    own = F.coalesce(F.col(author_col), F.lit("")) if author_col else F.lit("")
    found = articles.select(F.col(id_col).alias("id"), own.alias("own"), F.explode(F.concat(named, linked)).alias("c")).select("id", "own", "c.*")
    good = (F.col("source") == "citation_biz") | (account_name(F.col("name"), NO_NAMES) & (F.col("name") != F.col("own")))
    return found.filter(good).groupBy("id", "name", "source").agg(F.count(F.lit(1)).alias("n"))


def publish_time(html: Column) -> Column:
    """Publish time of a page: meta tag, time element, script variable, first date of the text."""
    ways = [r"(?i)<meta[^>]+published_time[^>]+content=\"([^\"]+)\"", r"(?i)<time[^>]+datetime=\"([^\"]+)\"", r"(?i)publish_time\s*=\s*\"([^\"]+)\"", r"\b(\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2})?)?)\b"]
    return F.coalesce(*[F.nullif(F.regexp_extract(html, w, 1), F.lit("")) for w in ways])


def article_date(text: Column, today: Column | None = None) -> Column:
    """Date of the usual spellings, CJK ones too; of a bare month and day the latest one that isn't after today."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(text, r"[年月/.]", "-"), r"日", ""))
    timed = F.coalesce(F.try_to_timestamp(plain, F.lit("yyyy-M-d HH:mm:ss")), F.try_to_timestamp(plain, F.lit("yyyy-M-d HH:mm")))
    day = F.try_to_timestamp(F.nullif(F.regexp_extract(plain, r"(\d{4}-\d{1,2}-\d{1,2})", 1), F.lit("")), F.lit("yyyy-M-d"))
    short = F.nullif(F.regexp_extract(plain, r"(\d{1,2}-\d{1,2})", 1), F.lit(""))
    now = F.current_date() if today is None else today
    of = lambda year: F.try_to_timestamp(F.concat(year.cast("string"), F.lit("-"), short), F.lit("yyyy-M-d"))
    this, last = of(F.year(now)), of(F.year(now) - 1)
    return F.coalesce(timed, day, F.when(this <= now.cast("timestamp"), this).otherwise(last))
