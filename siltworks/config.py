"""Weights, thresholds and defaults that results depend on. Each is a parameter of the operators that use it."""

SINGLE_DIMS = ("intent", "difficulty", "context")
MULTI_DIMS = ("language", "domain", "task", "concept", "agentic", "constraint")
DIMS = ("intent", "difficulty", "context", "language", "domain", "task", "concept", "agentic", "constraint")
VALUE_WEIGHTS = {"complexity": 0.25, "quality": 0.40, "reasoning": 0.20, "rarity": 0.15}
RARITY_WEIGHTS = {"intent": 0.15, "difficulty": 0.3, "context": 0.5, "language": 1.0, "domain": 1.5, "task": 1.0, "concept": 2.0, "agentic": 1.5, "constraint": 1.0}
COMBO_ALPHA = 0.7
COMBO_CAPS = {"language": 2, "domain": 2, "task": 2, "concept": 3, "agentic": 2, "constraint": 2}
LABEL_CONFIDENCE_DEFAULT = 0.75
INHERITED_LABEL_FACTOR = 0.65
INHERITED_SLICE_WEIGHT = 0.7
SCORE_ANCHOR = 5.5
RARITY_DEFAULT = 5.0
QUALITY_FLOOR = 4.0
QUALITY_FLOOR_FACTOR = 0.7
SELECTION = {"intra": 0.49, "quality": 0.20, "rarity": 0.31, "min_group": 5, "prior": 30, "confidence_floor": 0.25}
STAGE_VALUE = {"opener": 0.68, "exploration": 0.90, "implementation": 1.0, "verification": 1.03, "final-summary": 1.0}
STAGE_SELECTION = {"opener": 0.67, "exploration": 0.87, "implementation": 1.0, "verification": 1.05, "final-summary": 0.985}
LOW_INFO, NO_EVIDENCE, EVIDENCE = 0.82, 0.89, 1.04
FLAG_BASE = 0.95
RARITY_MIX = {"mean": 0.75, "peak": 0.25, "diversity": 0.4, "coverage_floor": 0.35}
TURN_SIGNAL = {"top": 5, "bottom": 3, "w_top": 0.70, "w_median": 0.20, "w_bottom": 0.10}
KEEP_THRESHOLDS = (4.0, 5.0, 6.0, 7.0)
LOW_CONFIDENCE = 0.60
SPARSE = {"full_label_count": 8, "gap_multiplier": 1.3, "min_gap": 2, "max_gap": 8, "threshold": 12}
PLANNER = {"threshold": 3.0, "min_segment": 2, "max_gap": 6, "fallback_ratio": 1.0}
SELECTIVE = {"min_turns": 8, "drift": 4}
WINDOWS = {"longer_than": 50, "size": 50, "stride": 30, "prefix": 3}
CLUSTER = {"dim": 384, "bits": 256, "seed": 42, "bands": 8, "radius": 64, "top_k": 32, "cosine": 0.82}
EXTENSION = {"min_baseline": 200, "bonus_cap": 0.5, "bonus_rate": 0.10}
PRUNE_RATIO = 0.5
