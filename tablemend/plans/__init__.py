from tablemend.plans.clean import Cleaned, ReduceRule, clean
from tablemend.plans.session import build_session
from tablemend.plans.stages import STAGES, MissingStageError, Stage, StageStore, shared_folder

__all__ = [
    "STAGES",
    "Cleaned",
    "MissingStageError",
    "ReduceRule",
    "Stage",
    "StageStore",
    "build_session",
    "clean",
    "shared_folder",
]
