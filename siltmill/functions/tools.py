"""Tool results as expressions: the fixed sentences of mock tools, calculators, file plans.

Arguments come as JSON text, the row's own fields as Columns. External searches are no expressions; see
``siltmill.operators.teacher``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltmill.functions import numbers
from siltmill.functions.text import first_truthy, strip

# The sentences of the mock tools. {0}, {1} stand for what the call or the row says.
ORDER_STATUS = "订单 {0} 当前状态：仓库处理中，预计 24 小时内发货。如超过预计时间仍未发出，可联系人工客服催办。"
SHIPPING_STATUS = "物流单号 {0} 当前节点：已揽收，正在发往下一分拨中心，预计 1-3 天内更新派送信息。"
REFUND_POLICY = "售后政策检索：{0}。一般情况下，未发货订单可申请取消；已发货订单需等待签收后按平台规则申请退换货。具体以订单页面展示政策为准。"
HEALTH_KNOWLEDGE = "健康管理知识参考：{0} 涉及健康评估、生活方式干预、风险沟通和随访管理，教学中应强调科学性、可操作性和安全边界。"
CURRICULUM = "课程/岗位能力参考：{0} 通常包含知识理解、技能操作、案例分析、沟通服务、职业素养和持续改进能力。"
PROFILE = "学情分析：学生画像为“{0}”。围绕“{1}”，建议关注基础知识、案例迁移、实操熟练度、沟通表达和反思改进能力。"
TASKS = "训练任务建议：针对“{0}”，在{1}可安排示范讲解、分步练习、案例模拟、同伴互评和复盘改进。"
RUBRIC = "评价量规参考：任务“{0}”可从知识准确性、操作规范性、方案完整性、沟通表达、风险意识和反思改进评价；核心能力为“{1}”。"
RESOURCES = "学习资源建议：围绕“{0}”可使用教材章节、微课、案例库、岗位标准、实训工作页和自测题，并按基础知识、技能练习、综合案例顺序学习。"
NOT_FOUND = "未检索到相关内容。检索语句：{0}"
PLAN_FILE = "已记录写文件需求：filename={0}；file_type={1}；write_purpose={2}；content_source={3}。最终文件内容待执行阶段生成后写入。"
BMI_TEXT, BMI_BAD = "BMI={0}，中国成人参考分类：{1}。", "计算失败：height_cm 和 weight_kg 必须为正数。"
WATER_TEXT, WATER_BAD = "按 {0} ml/kg 估算，每日饮水量约 {1} ml。需结合肾病、心衰、水肿等情况调整。", "计算失败：weight_kg 必须为正数。"
HEART_TEXT, HEART_BAD = "估算最大心率 {0} 次/分；{1} 强度目标心率约 {2}-{3} 次/分。", "计算失败：age 必须在 1-120 之间。"
FAILURE = "error：工具调用失败。失败工具：{0}。原因：{1}"
FAILURE_REASONS = ("请求超时，未能获取有效结果。", "外部服务暂时不可用。", "返回内容为空或格式异常。", "检索服务繁忙，请稍后重试。", "网络连接异常，工具未完成执行。")
#: Words added to a topic search, by tool.
SEARCH_SUFFIX = {
    "search_food_web": "食疗 饮食禁忌 营养 慢病饮食 健康建议", "search_exercise_web": "运动处方 功法 练习频率 禁忌 注意事项", "search_tcm_web": "中医体质 辨识 表现 调理 食疗 运动",
    "search_emotion_web": "情志调节 焦虑 睡眠 放松训练 心理健康", "search_safety_web": "红旗症状 何时就医 风险 用药禁忌 医学建议",
}
PLAN_FILE_NAME = "个性化健康管理方案.md"


def arg(arguments: Column, name: str) -> Column:
    return F.get_json_object(arguments, f"$.{name}")


def fill(template: str, *values: Column) -> Column:
    """``template`` with its numbered places taken by ``values``; null values are empty."""
    out, rest = [], template
    for i, v in enumerate(values):
        head, _, rest = rest.partition(f"{{{i}}}")
        out += [F.lit(head), F.coalesce(v, F.lit(""))]
    return F.concat(*out, F.lit(rest))


def _or(*columns: Column, default: str) -> Column:
    return F.coalesce(first_truthy(*columns), F.lit(default))


def customer_service(name: str, arguments: Column, order_id: Column, tracking_number: Column) -> Column:
    if name == "lookup_order_status":
        return fill(ORDER_STATUS, _or(arg(arguments, "order_id"), order_id, default="未知订单号"))
    if name == "lookup_shipping_status":
        return fill(SHIPPING_STATUS, _or(arg(arguments, "tracking_number"), tracking_number, default="未知物流单号"))
    if name == "search_refund_policy":
        return fill(REFUND_POLICY, _or(arg(arguments, "query"), default="退换货政策"))
    return F.lit(f"工具 {name} 未在客服领域注册，无法返回结果。")


def health_talent(name: str, arguments: Column, target: Column, user_query: Column, profile: Column) -> Column:
    a = lambda n: arg(arguments, n)
    made = {
        "search_health_management_knowledge": lambda: fill(HEALTH_KNOWLEDGE, _or(a("query"), target, user_query, default="健康管理")),
        "search_curriculum_standard": lambda: fill(CURRICULUM, _or(a("query"), target, default="健康管理岗位能力")),
        "analyze_learning_profile": lambda: fill(PROFILE, _or(a("student_profile"), profile, default="未提供详细学情"), _or(a("target_competency"), target, default="目标能力未明确")),
        "recommend_training_tasks": lambda: fill(TASKS, _or(a("skill_gap"), target, default="综合能力短板"), _or(a("training_stage"), default="基础到综合应用阶段")),
        "generate_assessment_rubric": lambda: fill(RUBRIC, _or(a("task"), user_query, default="实训任务"), _or(a("competencies"), target, default="综合职业能力")),
        "search_learning_resources": lambda: fill(RESOURCES, _or(a("query"), target, default="健康管理学习资源")),
    }
    return made[name]() if name in made else F.lit(f"工具 {name} 未在 health_talent 领域注册。")


def _number(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def _fixed(x: Column, digits: int) -> Column:
    """The number's decimal text, rounded half to even on its exact binary value like Python's format."""
    exact = x.cast("decimal(38,18)")
    return F.bround(exact, digits).cast(f"decimal(38,{digits})").cast("string")


def calculate_bmi(arguments: Column) -> Column:
    height, weight = _number(arg(arguments, "height_cm")), _number(arg(arguments, "weight_kg"))
    safe = F.when(height > 0, height)
    b = numbers.bmi(weight, safe)
    return F.when((height <= 0) | (weight <= 0), BMI_BAD).otherwise(fill(BMI_TEXT, _fixed(b, 1), numbers.bmi_category(b)))


def calculate_daily_water(arguments: Column) -> Column:
    weight, level = _number(arg(arguments, "weight_kg")), _or(arg(arguments, "activity_level"), default="normal")
    return F.when(weight <= 0, WATER_BAD).otherwise(fill(WATER_TEXT, numbers.water_factor(level).cast("string"), _fixed(numbers.daily_water_ml(weight, level), 0)))


def calculate_heart_rate(arguments: Column) -> Column:
    age = _number(arg(arguments, "age")).cast("int")
    level = F.lower(_or(arg(arguments, "intensity"), default="moderate"))
    low, high = numbers.heart_rate_zone(age, level)
    return F.when((age <= 0) | (age > 120), HEART_BAD).otherwise(fill(HEART_TEXT, (220 - age).cast("string"), level, low.cast("string"), high.cast("string")))


def search_rag(arguments: Column, rag_summary: Column) -> Column:
    """The row's own summary; there is no retrieval."""
    own = strip(F.coalesce(rag_summary, F.lit("")))
    return F.when(own != "", own).otherwise(fill(NOT_FOUND, strip(F.coalesce(arg(arguments, "query"), F.lit("")))))


def search_text(tool: str, query: Column) -> Column:
    """What a topic search asks for."""
    suffix = SEARCH_SUFFIX.get(tool)
    return F.concat_ws(" ", query, F.lit(suffix)) if suffix else query


def safe_file_name(name: Column) -> Column:
    last = strip(F.regexp_extract(_or(name, default=PLAN_FILE_NAME), r"([^/]*)/*$", 1))
    clean = F.regexp_replace(last, r"(?U)[^\w一-鿿.\-]+", "_")
    clean = F.when(clean.isin("", ".", ".."), PLAN_FILE_NAME).otherwise(clean)
    return F.when(F.lower(clean).rlike(r"[^.]\.(md|txt)$"), clean).otherwise(F.concat(clean, F.lit(".md")))


def plan_write_file(arguments: Column) -> Column:
    kept = lambda n, d: strip(_or(arg(arguments, n), default=d))
    return fill(PLAN_FILE, safe_file_name(arg(arguments, "filename")), kept("file_type", "markdown"), kept("write_purpose", "保存最终健康管理方案"), kept("content_source", "executor_final_answer"))


def random_number(arguments: Column, key: Column, seed: int) -> Column:
    """A whole number in the range, the same for a key on every run; swapped bounds are put right."""
    a, b = (F.coalesce(arg(arguments, n).try_cast("double").cast("long"), F.lit(d)) for n, d in (("min_value", 1), ("max_value", 100)))
    low, high = F.least(a, b), F.greatest(a, b)
    value = low + F.pmod(F.xxhash64(F.lit(seed), key), high - low + 1)
    purpose = strip(F.coalesce(arg(arguments, "purpose"), F.lit("")))
    lead = F.when(purpose != "", F.concat(F.lit("用途："), purpose, F.lit("；"))).otherwise("")
    return F.concat(lead, fill("随机整数={0}，范围=[{1}, {2}]。", value.cast("string"), low.cast("string"), high.cast("string")))


def current_datetime(zone: str = "Asia/Shanghai") -> Column:
    local = F.from_utc_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), zone)
    return F.concat(F.lit("当前时间："), F.date_format(local, "yyyy-MM-dd HH:mm:ss"), F.lit(f"；时区：{zone}。"))


def mock(name: str, arguments: Column, template: str = "") -> Column:
    """``template`` with {argument} places filled, or a line that lists the arguments."""
    import re

    if template:
        out = F.lit(template)
        for key in dict.fromkeys(re.findall(r"\{(\w+)\}", template)):
            out = F.replace(out, F.lit(f"{{{key}}}"), F.coalesce(arg(arguments, key), F.lit(f"{{{key}}}")))
        return out
    pairs = F.from_json(arguments, "map<string,string>")
    listed = F.array_join(F.transform(F.map_entries(pairs), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "；")
    return F.when(F.coalesce(F.size(pairs), F.lit(0)) > 0, F.concat(F.lit(f"（模拟结果）{name} 已执行："), listed)).otherwise(f"（模拟结果）{name} 已执行。")


def failure(tool: Column, key: Column, seed: int) -> Column:
    """The observation of an injected failure, with a seeded reason."""
    reason = F.element_at(F.array(*(F.lit(r) for r in FAILURE_REASONS)), (F.pmod(F.xxhash64(F.lit(seed), key), F.lit(len(FAILURE_REASONS))) + 1).cast("int"))
    return fill(FAILURE, tool, reason)


# Tool sets: which tools a row may see.


def expose(catalog: list[str], fixed: Column, mode: Column, required: Column, irrelevant: Column, key: Column, seed: int, most: int | None = 4, wanted: Column | None = None) -> Column:
    """Names of the tools a row sees: fixed ones if it has any, none, irrelevant ones, or the required ones with a
    seeded choice of others. The number is drawn between max(1, required) and ``most``, or is ``wanted`` within these."""
    names = F.array(*(F.lit(n) for n in catalog)).cast("array<string>")
    ordered = lambda a, s: F.transform(F.array_sort(F.transform(a, lambda x: F.struct(F.xxhash64(F.lit(s), key, x).alias("h"), x.alias("x")))), lambda p: p["x"])
    draw = lambda low, high, s: low + F.pmod(F.xxhash64(F.lit(s), key), high - low + 1).cast("int")
    pinned = F.array_intersect(F.array_distinct(F.coalesce(fixed, F.array().cast("array<string>"))), names)
    least = F.greatest(F.lit(1), F.size(required))
    cap = F.greatest(least, F.least(F.lit(len(catalog)), F.lit(most if most and most > 0 else len(catalog))))
    count = draw(least, cap, seed)
    if wanted is not None:
        count = F.coalesce(F.greatest(least, F.least(cap, wanted.cast("int"))), count)
    extra = F.slice(ordered(F.array_except(names, required), seed + 1), F.lit(1), F.greatest(count - F.size(required), F.lit(0)))
    normal = ordered(F.concat(required, extra), seed + 2)
    off = F.slice(ordered(irrelevant, seed + 3), F.lit(1), F.when(F.size(irrelevant) > 0, draw(F.lit(1), F.least(F.size(irrelevant), F.lit(most if most and most > 0 else len(catalog))), seed + 4)).otherwise(0))
    return F.when(F.size(pinned) > 0, pinned).when(mode == "no_tools", F.array().cast("array<string>")).when(mode == "irrelevant_tools", off).otherwise(normal)


def failing_calls(calls: Column, targets: str | None, budget: int, key: Column, seed: int) -> Column:
    """Ids of the calls that fail: at most ``budget`` of those to ``targets`` (comma list, empty for all), in seeded order."""
    wanted = [t.strip() for t in (targets or "").split(",") if t.strip()]
    able = F.filter(calls, lambda c: c["name"].isin(*wanted)) if wanted else calls
    ordered = F.array_sort(F.transform(able, lambda c: F.struct(F.xxhash64(F.lit(seed), key, c["id"]).alias("h"), c["id"].alias("id"))))
    return F.filter(F.transform(F.slice(ordered, F.lit(1), F.lit(max(0, budget))), lambda s: s["id"]), lambda i: i.isNotNull())
