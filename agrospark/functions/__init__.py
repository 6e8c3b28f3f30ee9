"""Column-level expressions: JVM-side, codegen-friendly, no Python UDFs."""

from agrospark.functions.calendar import cyclic, season2, season4  # noqa: F401
from agrospark.functions.agro import et0, kc_stage, soil_water_deficit, irrigation_efficiency  # noqa: F401
from agrospark.functions.numeric import snap, nan_to_null, score_cut, flag  # noqa: F401
from agrospark.functions.rolling import strict_avg, strict_sum  # noqa: F401
