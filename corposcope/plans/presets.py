"""Keyword presets: small tables of labels that travel inside expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Preset:
    name: str
    themes: Mapping[str, Sequence[str]]
    hooks: Mapping[str, Sequence[str]]
    arguments: Mapping[str, Sequence[str]]
    endings: Mapping[str, Sequence[str]]
    judgments: Sequence[str]
    boundary_themes: Sequence[str]
    boundary_words: Sequence[str]
    contributions: Mapping[str, Sequence[str]] = field(default_factory=dict)
    extra_contributions: Mapping[str, Sequence[str]] = field(default_factory=dict)


# The general Chinese preset.
GENERAL_ZH = Preset(
    name="general_zh",
    themes={
        "教程 / 方法": ("教程", "步骤", "方法", "如何", "怎么", "指南"),
        "案例 / 体验": ("案例", "体验", "实测", "现场", "故事", "经历"),
        "观点 / 解释": ("为什么", "原因", "机制", "观点", "分析", "解释"),
        "风险 / 边界": ("风险", "安全", "边界", "注意", "避免", "警惕"),
    },
    hooks={
        "问题 / 悬念入口": ("为什么", "怎么", "如何", "到底", "是不是", "能不能"),
        "反差 / 转折入口": ("你以为", "没想到", "其实", "但是", "结果", "反而"),
        "直接任务 / 方法入口": ("怎么", "如何", "步骤", "方法", "教程", "先"),
        "现场 / 体验入口": ("现场", "我在", "体验", "刚刚", "今天", "亲自"),
    },
    arguments={
        "步骤说明": ("第一步", "第二步", "接下来", "首先", "然后", "最后"),
        "机制解释": ("原理", "机制", "为什么", "本质", "逻辑", "背后", "原因"),
        "案例说明": ("比如", "例如", "案例", "经历", "故事"),
        "比较对照": ("相比", "对比", "以前", "现在", "一方面", "另一方面"),
        "现场观察": ("现场", "看到", "体验", "观察", "实测", "记录"),
    },
    endings={
        "边界判断": ("说明", "边界", "适用", "限制", "局限", "条件"),
        "行动建议": ("建议", "可以", "不要", "最好", "记住", "尝试"),
        "趋势判断": ("未来", "趋势", "接下来", "变化", "意味着"),
        "风险提醒": ("风险", "警惕", "安全", "避免", "注意", "违规"),
    },
    judgments=("门槛", "效率", "成本", "风险", "安全", "边界", "体验", "适用"),
    boundary_themes=("风险 / 边界",),
    boundary_words=("风险", "安全", "违规", "伤害", "欺骗", "隐私", "警惕", "避免"),
    contributions={
        "教程 / 方法": ("topic_model:method_tutorial",),
        "案例 / 体验": ("script_template:case_or_experience",),
        "观点 / 解释": ("judgment_heuristic:explanation",),
        "风险 / 边界": ("safety_boundary:risk_and_limits",),
    },
    extra_contributions={
        "judgment_heuristic:mechanism": ("机制", "原理", "本质", "为什么", "背后"),
        "judgment_heuristic:industry": ("未来", "趋势", "生态", "平台", "产业", "全球", "中国"),
    },
)

#: For the test tables, whose text is invented: licence lines, abuse, secrets, layout.
ENGLISH = Preset(
    name="english",
    themes={"licence": ("license", "licensed", "rights"), "abuse": ("idiot", "moron", "clown", "worthless"), "table": ("|",), "noise": ("!!", "$$$", "%%%")},
    hooks={"article": ("the ", "le ", "der ", "el "), "licence": ("license",)},
    arguments={"secret": ("token",), "contact": ("@",), "number": ("0", "1", "2", "3")},
    endings={"licence": ("license", "reserved"), "abuse": ("idiot", "moron")},
    judgments=("worthless", "license"),
    boundary_themes=("abuse",),
    boundary_words=("idiot", "moron", "worthless"),
    contributions={"licence": ("legal:licence",), "abuse": ("safety:abuse",)},
    extra_contributions={"secret:token": ("token",)},
)
