"""All query modules of the subpackage."""

from betaloom.llm import mixing_plans, overlap_plans, packing_plans, sampling_plans, sketch_plans, spam_plans

MODULES = [sketch_plans, sampling_plans, overlap_plans, packing_plans, mixing_plans, spam_plans]
