"""Errors raised by the guards; each names the job step that refused to go on."""


class LedgerError(Exception):
    """Base of every error this package raises."""


class LogReadError(LedgerError):
    """The transaction log is missing, empty, unreadable or of the wrong shape."""


class QualityError(LedgerError):
    """The log cannot be trained on."""


class SplitError(LedgerError):
    """The time split has bad arguments or an unusable part."""


class FeatureError(LedgerError):
    """A feature table is absent or does not match the registry."""


class ModelError(LedgerError):
    """A data set, run or model version cannot be used."""


class PredictionLogError(LedgerError):
    """The prediction log is absent or empty."""


class DriftError(LedgerError):
    """A drift comparison has nothing to compare."""
