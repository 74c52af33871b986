"""Band labels (B1-B11): the first bound that is strictly exceeded names the band."""

from pyspark.sql import Column, functions as F

# Lower bounds (exclusive) and labels of each report table.
KEYWORD_BANDS = [(0.5, "Très important"), (0.2, "Important"), (0.1, "Modéré"), (None, "Faible")]
COMPLETENESS_BANDS = [(80, "Excellent"), (60, "Bon"), (40, "Modéré"), (None, "Faible")]
RICHNESS_BANDS = [(30, "Très technique"), (20, "Technique"), (10, "Modérément technique"), (None, "Peu technique")]
WORDS_BANDS = [(100, "Très détaillé"), (50, "Détaillé"), (30, "Standard"), (None, "Concis")]
DEPTH_BANDS = [(20, "Très avancé"), (10, "Avancé"), (5, "Intermédiaire"), (None, "Basique")]
CLARITY_BANDS = [(80, "Excellent"), (60, "Bon"), (40, "Modéré"), (None, "Améliorable")]

# Author activity, lower bounds inclusive.
ACTIVITY_BANDS = [(10, "🔥 Très actif"), (5, "⚡ Actif"), (None, "📝 Contributeur")]


def band(col, bands, inclusive=False) -> Column:
    result = F
    for bound, label in bands:
        if bound is None:
            return result.otherwise(F.lit(label))
        result = result.when(col >= bound if inclusive else col > bound, F.lit(label))
    return result


def activity_band(question_count) -> Column:
    """B8."""
    return band(question_count, ACTIVITY_BANDS, inclusive=True)


def sentiment_class(polarity) -> Column:
    """B11."""
    return F.when(polarity > 0.1, "positive").when(polarity < -0.1, "negative").otherwise("neutral")


def refresh_flags(error_rate, per_second, skipped, updated) -> dict:
    """One boolean or label per recommendation."""
    return {
        "error_level": F.when(error_rate > 10, "high").when(error_rate > 0, "acceptable").otherwise("none"),
        "speed": F.when(per_second < 1, "slow").when(per_second > 10, "excellent").otherwise("normal"),
        "many_skipped": skipped > updated,
    }


def test_flags(passed, failed, errors, skipped, duration) -> dict:
    """B9."""
    return {
        "fix_errors": errors > 0,
        "fix_failures": failed > 0,
        "many_skipped": skipped > passed / 4,
        "slow_run": duration > 60,
        "active_tests_pass": (failed == 0) & (errors == 0),
        "all_tests_pass": (failed == 0) & (errors == 0) & (skipped == 0),
    }
