"""Facts from message text: amount, currency, type, account, channel, time, merchant and category as column expressions.

A null or blank body gives null in every column but those with a default. Rule tables are
data: an ordered list of (label, words) compiles to one ``when`` chain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "Asia/Shanghai"

# Word lists and patterns of the message formats, by output.
TEMPLATE_NOTICE = "com.tencent.mm广发信用卡: 交易成功提醒服务号UID："
LOAN_ADS = ["预放款", "预核准", "贷款最高", "额度最高", "中银E贷", "分子借钱", "智花"]
VALID_WORDS = ["消费", "付款", "支付", "已付", "扣款", "退款", "冲正", "赔款", "理赔", "到账", "入账", "还款", "转账", "买入"]
INVALID_WORDS = [
    "验证码", "动态码", "动态口令", "已承保", "已发货", "订单已生成", "电子发票", *LOAN_ADS, "当月账单", "最低还款额", "账单应还款金额",
    "出账日提醒", "余额不足", "未按时还款", "若已存足", "补充账户余额", "防空警报", "农业普查", "资源包即将到期",
]
NUMBER = r"\s*(?:人民币|RMB|￥)?\s*([0-9,]+(?:\.[0-9]+)?)"
AMOUNTS = [
    "(?:实付|实际应付|实扣|实际支付|自付)" + NUMBER,
    "(?:账单应还款金额为|账单应还金额为|当月账单为|账单为|应还款金额为|应还金额为|本期账单金额为?)" + NUMBER,
    "消费" + NUMBER,
    "(?:发起退款|退款)" + NUMBER,
    "(?:成功付款|您已付|付款|支付|扣款成功|扣款|已扣)" + NUMBER,
    "(?:赔款金额|理赔金额|到账金额|入账金额|已入账|到账)" + NUMBER,
    "(?<!最低)还款" + NUMBER,
    "交易成功" + NUMBER,
    r"(?:人民币|RMB|￥)\s*([0-9,]+(?:\.[0-9]+)?)",
]
CURRENCIES = [("USD", ["美元", "USD", "US$"]), ("HKD", ["港币", "HKD", "HK$"]), ("EUR", ["欧元", "EUR"])]
TYPE_IGNORED = ["当月账单", "最低还款额", "账单应还款金额", "余额不足", "未按时还款"]
CARD_TAILS = [
    r"尾号(?:为)?\s*([0-9]{4})\s*(?:的)?(?:信用卡|银行卡|储蓄卡|借记卡|账户|卡片|卡)",
    r"(?:信用卡|银行卡|储蓄卡|借记卡)(?:尾号|卡号|\()?([0-9]{4})\)?",
    r"(?:您|客户)?尾号(?:为|卡)?\s*([0-9]{4})",
]
PARCEL = ["快递", "运单", "包裹", "取件"]
ACCOUNTS = [
    ("CREDIT_CARD", ["信用卡"]), ("DEBIT_CARD", ["储蓄卡", "借记卡"]), ("WALLET", ["微信零钱", "零钱", "花呗", "余额宝"]),
    ("LOAN", ["贷款", "中银E贷", "供款账户"]),
]
CHANNELS = [("ALIPAY", ["支付宝", "花呗", "蚂蚁"]), ("WECHAT_PAY", ["财付通", "微信支付", "微信零钱"]), ("UNIONPAY", ["银联", "云闪付"])]
SENDERS = [
    ("CGB", ["95508", "广发银行", "广发信用卡"]), ("WECHAT_PAY", ["com.tencent.mm", "微信支付", "财付通"]), ("ALIPAY", ["Alipay", "支付宝", "蚂蚁金服"]),
    ("CMB", ["95555", "招商银行"]), ("BOC", ["95566", "中国银行"]), ("HSBC", ["95366", "汇丰银行", "汇丰中国", "HSBC"]),
    ("ICBC", ["95588", "工商银行"]), ("CCB", ["95533", "建设银行"]), ("ABC", ["95599", "农业银行"]),
]
SECOND_SIM = ["SubId：2", "SIM2", "卡槽2"]
CATEGORIES = [
    ("CAR_EXPENSE", ["汽车销售", "汽车服务", "欧亚特", "4S店", "维保", "汽车保养", "修车", "汽修", "机油", "汽车配件", "洗车", "车检", "年审", "轮胎", "补胎", "钣金", "喷漆"]),
    ("TRANSPORT", ["打车", "高德", "地铁", "公交", "停车", "易充", "南网电动", "汽车文化", "滴滴", "顺易通", "科拓", "车主", "加油"]),
    ("MEDICAL", ["医院", "大药房", "药店", "卫生服务", "门诊", "诊所", "慢病防治", "慢性病", "何贤", "番禺中心医院", "陪护"]),
    ("COMMUNICATION", ["话费", "中国移动", "中国联通", "中国电信", "宽带", "通信", "10086", "10010", "10000"]),
    ("INSURANCE", ["保费", "保单", "平安产险", "平安保险", "申能保险", "中意人寿", "人寿保险", "财产保险", "蚂蚁保"]),
    ("PROPERTY_MANAGEMENT", ["物业管理", "物业服务", "浩丰物业", "物业费", "管理费", "电网", "供电", "供电局", "电费", "水费", "自来水", "燃气", "燃气费", "南方电网"]),
    ("TRAVEL", ["文旅", "旅游文化", "景区", "门票", "旅行社", "度假", "苏荷文旅", "鼎基旅游"]),
    ("FOOD", ["快餐", "餐饮", "饭堂", "小面", "米线", "美食", "萨莉亚", "煲珠公", "奶昔", "生果", "蛋挞", "面馆", "料理", "咖啡", "莲香楼", "丰味馆", "索迪斯", "饿了么", "拉扎斯", "美团", "三快", "茶理宜世", "奶茶"]),
    ("ONLINE_SHOPPING", ["拼多多", "天猫", "淘宝", "京东", "得物", "唯品会", "抖音电商", "快手电商", "闲鱼", "苏宁易购", "当当网", "小米商城", "网易严选", "阿里", "电子商务", "艺牛"]),
    ("OFFLINE_SHOPPING", ["盒马", "超市", "沃尔玛", "永旺", "大润发", "山姆", "便利店", "康成投资", "今日卖场", "商贸", "箱包", "数码", "家具", "家居", "现代农业", "曼伦", "欧风麦甜", "所见所得", "百货", "商场"]),
]
NOT_A_PERSON = ["盒马", "美团", "高德", "易充", "京东", "淘宝", "天猫", "超市", "医院", "饭堂", "小面"]
PERSON = r"(?:交易商户|商户|收款方)[:：](?:支付宝|财付通|微信支付)?-?([\u4e00-\u9fa5]{2,4})[。，,\s]"
MERCHANT_LABEL = "交易商户[：:]([^。，,;\n\r]+)"
PAYEE = "向([^，,。]+?)(?:付款|支付|成功付款|转账)"
CORPORATE = [
    "网络科技有限公司", "电子商务有限公司", "信息科技有限公司", "供应链管理有限公司", "商贸有限公司", "投资有限公司", "科技有限公司", "餐饮管理有限公司",
    "物业管理有限公司", "通讯技术股份有限公司", "集团有限公司", "股份有限公司", "有限公司", "有限责任公司", "经营部",
]
ALIASES = {
    "拼多多平台商户": "拼多多", "浙江天猫供应链管理有限公司": "天猫", "天猫超市": "天猫超市", "盒马": "盒马鲜生", "广州盒马鲜生网络科技有限公司": "盒马鲜生",
    "北京三快在线科技有限公司": "美团", "美团": "美团", "上海拉扎斯信息科技有限公司": "饿了么", "高德打车": "高德打车", "高德地图": "高德打车",
    "广州地铁集团有限公司": "广州地铁", "广州地铁": "广州地铁", "康成投资（中国）有限公司": "大润发", "康成投资": "大润发", "沃尔玛（中国）投资有限公司": "沃尔玛",
    "沃尔玛": "沃尔玛", "杭州今日卖场供应链管理有限公司": "今日卖场", "支付宝支付科技有限公司": "支付宝平台服务", "中国平安财产保险": "中国平安",
    "中国平安": "中国平安", "平安产险": "中国平安", "中意人寿": "中意人寿", "申能保险": "申能保险",
}


def jtrim(x: Column) -> Column:
    """Trim every character up to U+0020 at both ends."""
    return F.regexp_replace(x, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def has(x: Column, words: Sequence[str]) -> Column:
    """Whether the text holds any of the words."""
    return reduce(or_, [x.contains(w) for w in words])


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x), with x evaluated once however often f uses it."""
    return F.get(F.transform(F.array(x), lambda v: f(v)), F.lit(0))


def first_label(x: Column, rules: Sequence[tuple[str, Sequence[str]]], default: Column) -> Column:
    """The first rule's label any of whose words the text holds."""
    out = None
    for label, words in rules:
        out = F.when(has(x, words), label) if out is None else out.when(has(x, words), label)
    return out.otherwise(default)


def _group(x: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, 1), F.lit(""))


def blank(body: Column) -> Column:
    """Whether a body is null or has nothing above U+0020."""
    return ~F.coalesce(body.rlike(r"[^\x00-\x20]"), F.lit(False))


def filled(body: Column, x: Column) -> Column:
    """x, or null for a null or blank body."""
    return F.when(~blank(body), x)


def code_only(body: Column) -> Column:
    return has(body, ["验证码"]) & ~has(body, ["消费", "付款", "已付"]) | body.startswith(TEMPLATE_NOTICE)


def is_valid_tx(body: Column) -> Column:
    vetoed = body.startswith(TEMPLATE_NOTICE) | has(body, INVALID_WORDS)
    return F.coalesce(filled(body, F.when(vetoed, False).otherwise(has(body, VALID_WORDS))), F.lit(False))


def amount_matches(body: Column) -> Column:
    """array<string>: what each pattern matched, null for none."""
    return F.array(*[_group(body, p) for p in AMOUNTS])


def amount(body: Column, matches: Column | None = None, zeros: bool = True) -> Column:
    """The first positive match by priority; with none, the value of the last pattern that matched, or null without ``zeros``. ``matches``: a column of ``amount_matches``."""
    seen = F.filter(amount_matches(body) if matches is None else matches, lambda r: r.isNotNull())
    values = F.transform(seen, lambda r: F.round(F.replace(r, F.lit(","), F.lit("")).try_cast("decimal(38,18)"), 2).try_cast("decimal(12,2)"))
    # each pattern is matched once: a fold keeps the first positive value, and the last one until then
    best = F.aggregate(values, F.lit(None).cast("decimal(12,2)"), lambda a, v: F.when(a > 0, a).otherwise(v))
    best = best if zeros else F.when(best > 0, best)
    return filled(body, F.when(~(code_only(body) | has(body, LOAN_ADS)), best))


def currency(body: Column, value: Column) -> Column:
    return F.when(value.isNull(), "CNY").otherwise(first_label(body, CURRENCIES, F.lit("CNY")))


def direction_type(body: Column) -> Column:
    """struct<direction, tx_type>, both null for a notice or without a telling word."""
    pair = lambda d, t: F.struct(F.lit(d).alias("direction"), F.lit(t).alias("tx_type"))
    none = F.struct(F.lit(None).cast("string").alias("direction"), F.lit(None).cast("string").alias("tx_type"))
    return (
        F.when(blank(body) | code_only(body) | has(body, TYPE_IGNORED), none)
        .when(has(body, ["退款", "冲正"]), pair("INFLOW", "REFUND"))
        .when(has(body, ["还款"]) & ~has(body, ["最低还款", "账单为", "账单应还"]), pair("OUTFLOW", "TRANSFER"))
        .when(has(body, ["赔款", "理赔", "到账", "入账"]), pair("INFLOW", "INCOME"))
        .when(has(body, ["消费", "付款", "支付", "已付", "扣款"]), pair("OUTFLOW", "EXPENSE"))
        .when(has(body, ["转账", "买入"]), pair("OUTFLOW", "TRANSFER"))
        .otherwise(none)
    )


def card_tail(body: Column) -> Column:
    return filled(body, F.when(~has(body, PARCEL), F.coalesce(*[_group(body, p) for p in CARD_TAILS])))


def account_type(body: Column, tail: Column) -> Column:
    by_tail = F.when(tail.isNotNull() & has(body, ["银行卡"]), "DEBIT_CARD")
    return filled(body, F.when(~has(body, PARCEL), first_label(body, ACCOUNTS, by_tail)))


def payment_channel(body: Column) -> Column:
    return filled(body, first_label(body, CHANNELS, F.lit("DIRECT")))


def _times(body: Column, received: Column, zone: str, roll_back: bool = False) -> tuple[Column, Column]:
    """The stamp at the end, and day and time in the body on the local month of receipt; each null where absent or no real time.

    With ``roll_back``, a time in the body over a day after receipt lies in the month before.
    """
    stamp = F.try_to_timestamp(F.regexp_replace(_group(body, r"SubId[：:]\s*[0-9]+?(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2})"), r"\s+", " "), F.lit("yyyy-MM-dd HH:mm:ss"))
    day = r"(\d{1,2})日(\d{1,2}):(\d{2})"
    part = lambda k: F.regexp_extract(body, day, k)
    local = F.from_utc_timestamp(received, zone)
    text = lambda month: F.concat_ws("", F.date_format(month, "yyyy-MM-"), F.lpad(part(1), 2, "0"), F.lit(" "), F.lpad(part(2), 2, "0"), F.lit(":"), part(3))
    on = lambda month: F.to_utc_timestamp(F.when(part(1) != "", F.try_to_timestamp(text(month), F.lit("yyyy-MM-dd HH:mm"))), zone)
    inside = on(local)
    if roll_back:
        inside = F.when(inside > received + F.expr("interval 1 day"), on(F.add_months(local, -1))).otherwise(inside)
    return F.to_utc_timestamp(stamp, zone), inside


def tx_time(body: Column, received: Column, zone: str = ZONE, roll_back: bool = False) -> Column:
    """The stamp, else the time in the body, else receipt; instants as UTC wall time."""
    return F.coalesce(*_times(body, received, zone, roll_back), received)


def time_source(body: Column, received: Column, zone: str = ZONE) -> Column:
    """Where ``tx_time`` comes from: stamp, body or received."""
    stamp, inside = _times(body, received, zone)
    return F.when(stamp.isNotNull(), "stamp").when(inside.isNotNull(), "body").otherwise("received")


def counterparty(body: Column) -> Column:
    label, payee = _group(body, MERCHANT_LABEL), _group(body, PAYEE)
    fixed = (
        F.when(has(body, ["中意人寿"]), "中意人寿").when(has(body, ["申能保险"]), "申能保险").when(has(body, ["平安产险", "中国平安"]), "中国平安")
        .when(has(body, ["港华燃气"]), "港华燃气").when(has(body, ["【话费账单】"]) | has(body, ["中国移动"]) & has(body, ["消费"]), "中国移动")
    )
    return filled(body, F.nullif(F.when(label.isNotNull(), jtrim(label)).when(payee.isNotNull(), jtrim(payee)).otherwise(fixed), F.lit("")))


def cleaned_merchant(party: Column, aliases: dict[str, str] | None = None) -> Column:
    names = F.create_map(*[F.lit(x) for pair in (aliases or ALIASES).items() for x in pair])
    raw = jtrim(F.regexp_replace(party, "^(?:支付宝|财付通|微信支付|银联)-", ""))
    bare = jtrim(F.regexp_replace(raw, "收款$", ""))

    def cut(x: Column) -> Column:
        """Without the first suffix in the list that fits, if something remains."""
        chain = F.when(F.lit(False), x)
        for suffix in CORPORATE:
            chain = chain.when(x.endswith(suffix) & (F.length(x) > len(suffix)), F.left(x, F.length(x) - len(suffix)))
        return jtrim(chain.otherwise(x))

    named = lambda x: F.coalesce(F.try_element_at(names, x), F.nullif(x, F.lit("")))
    return F.coalesce(once(raw, lambda r: F.try_element_at(names, r)), once(once(bare, cut), named), party)


def personal_transfer(body: Column) -> Column:
    """Whether the merchant label names what looks like a person; False for a null body."""
    person = _group(body, PERSON)
    return F.coalesce(person.isNotNull() & ~has(person, NOT_A_PERSON), F.lit(False))


def category(body: Column, rules: Sequence[tuple[str, Sequence[str]]] = CATEGORIES) -> Column:
    rest = F.when(personal_transfer(body), "PERSONAL_TRANSFER").otherwise("OTHER")
    return filled(body, first_label(body, rules, rest))


#: What each fact is made of, by name: functions of a message's columns (raw_body, received_at, sender, id and ``MATCHED``).
#: The facts come in steps, so that later ones can use ``FIRST``; a caller may pass other or more ``FACTS``. Long rule chains
#: stand in lambdas (``once``), as generated code of their size in one projection would not be compiled to machine code.
MATCHED = {"amount_matches": lambda: amount_matches(F.col("raw_body")), "label": lambda: direction_type(F.col("raw_body"))}
FIRST = {
    "amount": lambda: amount(F.col("raw_body"), F.col("amount_matches")),
    "card_tail": lambda: card_tail(F.col("raw_body")),
    "counterparty": lambda: once(F.col("raw_body"), counterparty),
}
FACTS = {
    "raw_record_id": lambda: F.col("id"),
    "tx_time": lambda: F.coalesce(tx_time(F.col("raw_body"), F.col("received_at")), F.current_timestamp()),
    "amount": lambda: F.col("amount"),
    "currency": lambda: currency(F.col("raw_body"), F.col("amount")),
    "direction": lambda: F.col("label.direction"),
    "tx_type": lambda: F.col("label.tx_type"),
    "institution": lambda: F.col("sender"),
    "account_type": lambda: account_type(F.col("raw_body"), F.col("card_tail")),
    "card_tail": lambda: F.col("card_tail"),
    "payment_channel": lambda: payment_channel(F.col("raw_body")),
    "counterparty": lambda: F.col("counterparty"),
    "cleaned_merchant": lambda: cleaned_merchant(F.col("counterparty")),
    "category": lambda: once(F.col("raw_body"), category),
    "is_valid_tx": lambda: is_valid_tx(F.col("raw_body")),
    "etl_created_at": lambda: F.current_timestamp(),
}


def to_transactions(messages: DataFrame, facts: dict[str, Callable[[], Column]] | None = None, tasks: int | None = None, zeros: bool = True) -> DataFrame:
    """Facts (id and the entries of ``FACTS``) from messages (id, sender, received_at, raw_body), without a shuffle.

    ``facts`` replaces or adds entries by name. ``tasks`` deals the messages out first: for
    few files (or one that cannot be split) and many cores, as the patterns cost more than that.
    Without ``zeros`` a message without a positive amount has none, and so no other currency.
    """
    each = lambda table: [f().alias(n) for n, f in table.items()]
    base = messages.select("id", "sender", "received_at", "raw_body")
    base = base if tasks is None else base.repartition(tasks)
    # the text comes out of a generator, so that a filter on facts is not moved to before the dealing, with the text made anew for each of its words
    base = base.select("id", "sender", "received_at", F.explode(F.array("raw_body")).alias("raw_body")).select("*", *each(MATCHED))
    table = FIRST if zeros else FIRST | {"amount": lambda: amount(F.col("raw_body"), F.col("amount_matches"), zeros=False)}
    first = base.select("id", "sender", "received_at", "raw_body", "label", *each(table))
    return first.select("id", *each(FACTS | (facts or {})))


def raw_body(subject: Column, body: Column) -> Column:
    return F.coalesce(F.nullif(jtrim(body), F.lit("")), jtrim(subject), F.lit(""))


def sender(subject: Column, body: Column) -> Column:
    return first_label(F.concat_ws(" ", F.coalesce(subject, F.lit("")), F.coalesce(body, F.lit(""))), SENDERS, F.lit("OTHER"))


def sim_slot(subject: Column, body: Column) -> Column:
    text = F.concat_ws(" ", F.coalesce(subject, F.lit("")), F.coalesce(body, F.lit("")))
    return F.when(has(text, SECOND_SIM), "SIM_SLOT_2").otherwise("SIM_SLOT_1")


def msg_uid(message_id: Column, body: Column) -> Column:
    return F.sha2(F.concat_ws("_", F.coalesce(message_id, F.lit("")), body), 256)


def simple_facts(messages: DataFrame, tail: str = r"尾号(\d{4})", value: str = r"([0-9]+\.[0-9]{2})元") -> DataFrame:
    """id, card_tail and amount by two patterns only."""
    return messages.select("id", _group(F.col("body"), tail).alias("card_tail"), F.regexp_extract("body", value, 1).try_cast("decimal(10,2)").alias("amount"))


def strip_html(html: Column) -> Column:
    return jtrim(F.regexp_replace(html, "<[^>]*>", ""))


def body_of_parts(parts: Column) -> Column:
    """The text of a message in parts (array<struct<is_html, content>>): html without tags, parts that are null left out, one to a line."""
    texts = F.transform(F.filter(parts, lambda p: p["content"].isNotNull()), lambda p: F.when(p["is_html"], strip_html(p["content"])).otherwise(p["content"]))
    return jtrim(F.array_join(texts, "\n"))


#: Fields of a raw message by name: functions of an email's columns (subject, body, message_id, received_at, uid).
RAW = {
    "sender": lambda: sender(F.col("subject"), F.col("body")),
    "receiver_phone": lambda: sim_slot(F.col("subject"), F.col("body")),
    "received_at": lambda: F.coalesce("received_at", F.current_timestamp()),
    "raw_body": lambda: raw_body(F.col("subject"), F.col("body")),
    "created_at": lambda: F.current_timestamp(),
}


def assemble_raw(emails: DataFrame, channel: str = "SMS", fields: dict[str, Callable[[], Column]] | None = None) -> DataFrame:
    """Raw messages (8 columns) from emails (uid, message_id, subject, received_at, body); a null uid becomes a stable hash.

    ``fields`` replaces or adds entries of ``RAW`` by name.
    """
    uid = msg_uid(F.col("message_id"), raw_body(F.col("subject"), F.col("body")))
    return emails.select(
        F.coalesce("uid", F.xxhash64(uid)).alias("id"), uid.alias("msg_uid"), F.lit(channel).alias("channel"), *[f().alias(n) for n, f in (RAW | (fields or {})).items()],
    )
