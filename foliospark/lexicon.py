"""Vocabularies and grammars that operators take as an argument; DEFAULT is the maintenance-manual domain."""

from __future__ import annotations

from dataclasses import dataclass, field


# Fixed values of the domain.
CODE_PREFIXES = ("SP", "SV", "PS", "DS", "SR", "SW", "EX", "OH", "PC", "OT", "IO", "APC", "FSSB")
SOURCE_PRIORITIES = {"alarm": 1.0, "alarm_candidate": 0.95, "warning": 0.9, "procedure": 0.8, "table": 0.7, "table_candidate": 0.7, "image": 0.6, "page_context": 0.3, "text": 0.5}
CHUNK_LIMITS = {"procedure": 800, "text": 1000, "other": 1200}
WARNING_PATTERN = "(?i)(警告|注意|危险|小心|WARNING|CAUTION|DANGER)"
STEP_PATTERN = r"(?i)(^|\n)\s*(步骤|STEP|\d+[).、])\s*"
STEP_START_PATTERN = r"(?i)^(?:STEP\s*\d+|\d+[.)、]|[一二三四五六七八九十]+[、.])\s*"
PARAMETER_PATTERN = r"(?iU)\b([A-Z]{2,12}(?:\s*\(\s*NO\.\s*\d+(?:#\d+)?\s*\))?(?:\s*#\d+)?(?:\s*=\s*[\dA-Z]+)?)\b"
QUERY_PARAMETER_PATTERN = r"(?iU)\b(?:PARAM(?:ETER)?\s*)?(?:NO\.)?\s*(\d{3,5}(?:#\d+)?)\b"
PLC_PATTERN = r"(?i)\b([A-Z]?\d{1,4}\.\d)\b"
KB_COMPONENTS = ("主轴", "伺服", "CNC", "PMC", "PLC", "FSSB", "APC", "参数", "电缆", "电机", "编码器", "放大器", "电源", "刀库", "润滑", "冷却")
QUERY_COMPONENTS = ("主轴", "伺服", "电池", "风扇", "编码器", "放大器", "PMC", "PLC", "CNC", "FSSB", "APC", "USB", "存储卡", "刀库", "润滑", "冷却", "电机", "电源", "电缆")
INTENTS = (
    ("safety", ("安全", "警告", "注意", "禁止", "触电", "高压")),
    ("procedure", ("步骤", "怎么操作", "如何更换", "如何设置", "怎么更换", "怎么设置", "方法", "如何查看", "查看", "画面")),
    ("parameter_setting", ("参数", "设定", "设置值", "参数值")),
    ("troubleshooting", ("怎么办", "怎么处理", "如何排查", "原因", "故障", "异常", "报错", "报警")),
    ("explain", ("是什么", "什么意思", "解释")),
)
SAFETY_WORDS = ("安全", "警告", "注意", "禁止", "高压", "触电")
FAULT_SECTION_WORDS = ("故障", "报警", "维修")
SUSPECT_TOKENS = ("鍙", "缁", "涔", "鐨", "鎴", "鎿", "灏", "鍦", "閫", "浣", "鐩", "瀛", "銆", "锛", "锟", "€", "�", "鈥")
SUPPLEMENT_PREFIXES = ("补充信息", "补充：", "补充:", "用户：", "用户:", "现场补充", "补充说明")
EDGE_WEIGHTS = {"mentions": 0.7, "triggers": 1.0, "depends_on": 0.8, "adjacent": 0.4, "same_page": 0.35, "related_context": 0.5}
BLOCK_SOURCES = {"light": "docling_layout", "refined": "refined_docling_page", "ocr_fixed": "dashscope_ocr", "merged": "page_context_aggregate"}
REFINE_PRIORITIES = {"manual": 100, "alarm_dense": 90, "alarm_candidate": 80, "table_candidate": 70, "low_text": 50, "image": 40, "block_needs_refine": 30}
ANSWER_TYPES = {"alarm_diagnosis": "alarm_troubleshooting", "alarm_explain": "alarm_explain", "procedure_lookup": "procedure_answer", "parameter_lookup": "parameter_answer", "safety_lookup": "safety_answer"}
ROLE_WORDS = {
    "safety_warning": ("安全", "警告", "注意", "禁止", "断电", "高压", "触电"),
    "inspection_step": ("检查", "确认", "步骤", "更换", "设置", "设定", "复位", "查看", "画面", "测量"),
    "parameter": ("参数", "设定", "设置值", "PWE", "NO.", "#", "PMC ADDRESS", "PLC"),
    "possible_cause": ("原因", "可能", "异常", "故障", "错误", "通信", "报警"),
}
ROLE_PRIORITIES = {"alarm_definition": 1.0, "possible_cause": 0.8, "inspection_step": 0.7, "parameter": 0.6, "safety_warning": 0.5, "context": 0.2}
SECTIONS = {
    "alarm_troubleshooting": ("报警结论", "报警优先级", "每个报警的手册出处", "可能原因", "现场检查步骤", "禁止操作/安全提醒", "需要客户补充的信息"),
    "alarm_explain": ("报警结论", "每个报警的手册出处", "可能原因", "禁止操作/安全提醒", "需要客户补充的信息"),
    "procedure_answer": ("操作目标", "手册出处", "现场检查步骤", "禁止操作/安全提醒", "需要客户补充的信息"),
    "parameter_answer": ("参数结论", "手册出处", "参数说明", "现场检查步骤", "禁止操作/安全提醒", "需要客户补充的信息"),
    "safety_answer": ("安全结论", "手册出处", "禁止操作/安全提醒", "需要客户补充的信息"),
    "general_answer": ("问题结论", "手册出处", "可能原因", "现场检查步骤", "禁止操作/安全提醒", "需要客户补充的信息"),
}
MISSING_INFO = {
    "alarm_troubleshooting": ("请提供 CNC 当前完整报警画面", "请确认是否同时存在其他 SP/SV/DS/FSSB 报警", "请提供主轴/伺服放大器 LED 显示状态", "请确认报警发生时机", "请确认近期是否更换过电机、放大器、电缆或参数"),
    "procedure_answer": ("请确认当前所处画面或参数页面", "请确认机床是否已经停机并处于可操作状态", "请确认当前控制单元/板卡型号"),
    "parameter_answer": ("请提供参数号和当前参数值", "请确认是否允许参数写入", "请说明目标功能或想达到的设定结果"),
    "safety_answer": ("请说明当前维修对象和操作步骤", "请确认是否涉及断电、高压或板卡拆装"),
    "general_answer": ("请提供更完整的现场现象或报警文本", "请提供相关画面或手册截图"),
}
REASON_NO_CODE = "缺少命中同报警码的手册证据"
REASON_TOO_LITTLE = "手册证据不足，缺少明确步骤或故障定义"
SAFETY_SECTION, CAUSE_SECTION, STEP_SECTION, PARAMETER_SECTION, INFO_SECTION = "禁止操作/安全提醒", "可能原因", "现场检查步骤", "参数说明", "需要客户补充的信息"
SOURCE_SECTIONS = ("每个报警的手册出处", "手册出处")
CONCLUSION_SECTION, CONCLUSION_DEFAULT = "报警结论", "手册证据不足，无法确认具体报警结论。"
FIXED_SECTIONS = {"报警优先级": "建议先停止继续加工，优先确认报警与通信链路相关证据。", "安全结论": "维修前应先确认风险点，并严格按手册安全注意事项操作。", "操作目标": "根据手册相关步骤完成当前操作/查看动作。", "问题结论": "已根据当前证据整理相关手册内容，建议按步骤继续确认。"}
CAUSE_DEFAULT, STEP_DEFAULT, PARAMETER_DEFAULT = "手册未给出明确原因，请结合现场信息补充判断。", "手册证据中未检出明确步骤，请补充现场画面和当前状态。", "手册证据中未检出明确参数说明。"
SAFETY_DEFAULT = ("涉及放大器、板卡、电池、电缆插拔前，应先断开外部供给电源。", "未确认故障原因前，不建议继续加工或带负载运行。")
WHY_MAIN, WHY_CODE, WHY_STEP, WHY_SAFETY, WHY_GRAPH, WHY_SUPPORT, WHY_REPAIR = "高相关主证据", "命中报警码 ", "命中现场检查或操作步骤", "命中维修安全提醒", "Graph 扩展得到的辅助证据", "辅助证据", "维修或更换相关安全提醒"
NOT_ENOUGH = "证据不足"
PROMPT_RULES = "你是工业 CNC 维修手册问答助手。你只能根据证据材料回答，不允许编造。如果证据不足，请明确说明，并列出需要客户补充的信息。涉及维修、更换、断电、高压、放大器、电池、保险丝时，必须给出安全提醒。输出必须是 JSON 对象，字段为 answer、citations、confidence。"
PROMPT_OUTPUT = "1. answer 下必须包含模板要求的所有 section。\n2. 每条关键结论必须尽量引用页码和章节。\n3. 不允许出现证据中没有的报警码或页码。\n4. 如果 can_answer=false，必须明确说明证据不足。\n5. 输出 JSON，不要额外解释。"


@dataclass(frozen=True)
class Lexicon:
    prefixes: tuple[str, ...] = CODE_PREFIXES
    warning: str = WARNING_PATTERN
    step: str = STEP_PATTERN
    step_start: str = STEP_START_PATTERN
    parameter: str = PARAMETER_PATTERN
    components: tuple[str, ...] = KB_COMPONENTS
    query_components: tuple[str, ...] = QUERY_COMPONENTS
    intents: tuple = INTENTS
    safety_words: tuple[str, ...] = SAFETY_WORDS
    fault_words: tuple[str, ...] = FAULT_SECTION_WORDS
    supplements: tuple[str, ...] = SUPPLEMENT_PREFIXES
    suspects: tuple[str, ...] = SUSPECT_TOKENS
    role_words: dict = field(default_factory=lambda: dict(ROLE_WORDS))
    priorities: dict = field(default_factory=lambda: dict(SOURCE_PRIORITIES))
    #: The grammar of a code as it stands in texts, one group, where it isn't that of the prefixes.
    code_pattern: str | None = None

    @property
    def code(self) -> str:
        """A code with its letters and digits possibly apart, one group."""
        if self.code_pattern is not None:
            return self.code_pattern
        letters = "|".join(r"\s*".join(p) for p in self.prefixes)
        return rf"(?iU)\b((?:{letters})\s*[-_]?\s*\d(?:\s*\d){{1,4}})\b"

    @property
    def compact_code(self) -> str:
        return rf"(?i)\b((?:{'|'.join(self.prefixes)})\d{{2,5}})\b"


DEFAULT = Lexicon()
