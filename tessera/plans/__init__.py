from tessera.plans import messages, ratings, sensors, social, weblog

__all__ = ["messages", "ratings", "sensors", "social", "weblog"]
