"""Errors raised by the library, one family per stage."""


class AvalError(Exception):
    """Root of every error raised on purpose by this package."""


class LoadError(AvalError):
    """A source could not be loaded."""


class MissingPathError(LoadError):
    """No path was given."""


class SourceNotFoundError(LoadError):
    """The path matches no file."""


class UnsupportedFormatError(LoadError):
    """The extension has no reader."""


class ParseError(LoadError):
    """The file exists but its content cannot be read in that format."""


class ValidationError(AvalError):
    """A source does not satisfy its contract."""


class MissingColumnsError(ValidationError):
    """Expected columns are absent from a source."""


class UnknownSourceError(ValidationError):
    """The source name is not one of the known sources."""


class PreprocessingError(AvalError):
    """The combined table cannot be labelled or prepared."""


class RuleColumnsError(PreprocessingError):
    """Columns needed by the business rule are absent."""


class PreparationError(PreprocessingError):
    """The data cannot be turned into model inputs."""


class TrainingError(AvalError):
    """Base of model errors."""


class InvalidTrainingDataError(TrainingError):
    """Inputs are empty, not numeric, incomplete, single-class or differ from training."""


class NotTrainedError(TrainingError):
    """A prediction was requested before fitting."""


class EvaluationError(AvalError):
    """The evaluation cannot be computed."""
