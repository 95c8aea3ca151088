"""Word lists, aliases and thresholds that results depend on."""

CATEGORIES = {
    "Arithmetic": ["arithmetic", "arithmetic design error", "arithmetic safety", "arithmetic_safety", "bit width management"],
    "Clock/Timing": ["clock domain crossing", "clocking", "pipeline design", "pipeline synchronization"],
    "Compilation Error": ["compilation error", "compile error", "declaration", "syntax", "syntax errors", "syntax_error"],
    "Functional Logic": [
        "arithmetic_logic", "control logic", "control_logic_design", "data_path", "data_path_design", "design error", "design pattern", "fifo design error",
        "functional", "functional design", "functional logic", "functional logic bug", "functional logic bugs", "functional_correctness", "functional_design",
        "functional_logic", "functional_logic_bug", "functional_logic_bugs", "implementation_pattern", "logic", "logic errors", "logic_design", "stack memory",
        "task-specific design errors",
    ],
    "Interface Compliance": [
        "functional_specification", "interface", "interface/implementation", "interface/specification", "interface_compliance", "interface_design",
        "interface_specification", "module_interface", "port_mismatch", "spec_compliance", "specification compliance", "specification interpretation",
        "specification mismatch", "specification/interface", "specification/interface mismatch", "specification/interface_mismatches",
        "specification_compliance", "specification_interface", "specification_mismatch",
    ],
    "Language Compliance": [
        "code_quality", "coding style", "coding_style", "documentation", "language compliance", "portability", "syntax/compatibility",
        "syntax_and_language_compliance", "synthesis_compatibility",
    ],
    "Output Format": ["output format", "output format error", "output-format"],
    "Process/Methodology": ["process improvement"],
    "State Machine": ["state machine", "state machine error"],
    "Synthesis": ["synthesis", "synthesis error", "synthesis warnings"],
    "Verification": ["simulation termination", "simulation_termination", "verification", "verification/functional"],
}
CATEGORY_CASCADE = [
    (["interface", "specification", "module name", "port mismatch"], "Interface Compliance"),
    (["syntax", "compile"], "Compilation Error"),
    (["language", "code quality", "portability", "documentation"], "Language Compliance"),
    (["synthesis"], "Synthesis"),
    (["clock", "timing", "pipeline"], "Clock/Timing"),
    (["verify", "test"], "Verification"),
    (["logic", "functional", "design"], "Functional Logic"),
]
TYPE_ALIASES = {
    "functional": "functional_bug_fix", "functional logic": "functional_bug_fix", "functional_logic": "functional_bug_fix",
    "implementation pattern": "implementation_pattern", "interface compliance": "spec_compliance", "interface_compliance": "spec_compliance",
    "specification compliance": "spec_compliance", "specification_compliance": "spec_compliance",
}
PATTERN_CUES = ["pattern", "instantiate", "architecture", "concatenation"]
STYLE_CUES = ["readability", "comment", "documentation", "maintainability", "review", "style", "portability"]
PROCESS_CUES = ["verify", "checker", "process", "workflow"]
ROOT_ALIASES = {
    "state_machine": "fsm", "signed_unsigned": "signedness", "sign": "signedness", "parameter": "parameterization", "clocking": "timing",
    "clock": "timing", "compile": "syntax", "spec": "interface",
}
ROOT_HINTS = [
    ("reset", "reset"), ("width", "width"), ("sign", "signedness"), ("interface", "interface"), ("port", "interface"), ("fsm", "fsm"), ("state", "fsm"),
    ("cdc", "cdc"), ("clock", "timing"), ("timing", "timing"), ("parameter", "parameterization"), ("handshake", "handshake"), ("arith", "arithmetic"),
    ("divide", "arithmetic"), ("overflow", "arithmetic"), ("underflow", "arithmetic"), ("syntax", "syntax"), ("compile", "syntax"), ("arch", "architecture"),
]
WIDE_ROOTS = ["syntax", "width", "parameterization", "signedness"]
DECLARATION_CUES = ["always declare", "declare every", "all signals", "all nets", "module level", "every signal", "verilog syntax"]
SPECIFIC_ROOTS = ["architecture", "arithmetic", "cdc", "fsm", "handshake", "interface", "parameterization", "reset", "signedness", "syntax", "timing", "width"]
CORE_CATEGORIES = [
    "Arithmetic", "Clock/Timing", "Compilation Error", "Functional Logic", "Interface Compliance", "Language Compliance", "Output Format", "State Machine",
    "Synthesis", "Verification",
]
GENERIC_TERMS = ["counter", "fsm", "interface", "overflow", "pipeline", "reset", "signed", "timing", "underflow", "unsigned", "width"]

GATE_VAGUE = ["always review", "be careful", "check syntax", "clarify spec", "double.?check", "make sure", "test thoroughly"]
SCORE_VAGUE = ["always review", "be careful", "clarify spec", "comment could be clearer", "double.?check", "make sure", "readability", "test thoroughly"]
GATE_META = [
    "acceptable warning", "always verify", "comment", "documentation", "maintainability", "portability", "readability", "review checker output", "reviewer",
    "style", "tool may", "verification may",
]
SCORE_META = ["acceptable warning", "comment", "documentation", "maintainability", "portability", "readability", "review", "style", "tool may", "verification may"]
SPECULATIVE = ["default to", "if unspecified", "many verification environments", "testbench expectations?", "verification environment expects?", "when .* unspecified"]
WORKAROUND = ["allow verification completion", "cycle limit", "error recovery in verification", "simulation timeout", "verification framework"]
ACTION = [
    "add", "align", "assign", "compare", "declare", "ensure", "extend", "guard", "implement", "instantiate", "latch", "remove", "replace", "reset",
    "sign-extend", "toggle", "use", "zero-extend",
]
EVIDENCE = [
    "assert", "checker", "compile", "detail", "error", "failed", "function error", "mismatch", "simulation", "stale", "timeout", "verification", "warning",
]
CONFLICT = ["acceptable", "consider", "could", "may", "might", "optional", "prefer", "sometimes"]
