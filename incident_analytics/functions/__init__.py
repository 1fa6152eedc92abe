from incident_analytics.functions.scalar import *  # noqa: F401,F403
