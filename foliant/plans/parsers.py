"""Parsers and classifiers on texts whose answers are known, wrong and doubtful ones among them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from foliant.functions import casenum, dates, rules, ruling, text, textquality
from foliant.operators import discovery, evidence, extraction, people, responses
from foliant.operators import study as studies
from foliant.plans.base import AS_OF, known, planted

c = F.col
joined = lambda x, by="; ": F.array_join(x, by)
fields = lambda struct, *names: {n: struct[n] for n in names}

# The texts below are test cases with literally known answers.
known(
    "q10_ruling_reader", "orders", "o_orderkey", "text string", ["effect", "rule", "point", "source"],
    [
        (("CONSIDERANDO. POR TANTO: resuelve: I) Confirma la sentencia apelada. II) Notifíquese.",), ("mantiene", "confirma", "confirma la sentencia apelada.", "regla")),
        (("POR TANTO, al resolver: I) Revoca la sentencia venida en grado. II) Condena en costas.",), ("altera", "revoca", "revoca la sentencia venida en grado.", "regla")),
        (("POR TANTO resuelve: I) Confirma con la modificación de que la multa es de mil quetzales.",), ("mantiene", "confirma; la modificacion es accesoria", "confirma con la modificacion de que la multa es de mil quetzales", "regla")),
        (("POR TANTO resuelve: I) Confirma la sentencia con la modificación de que otorga el amparo.",), ("altera", "confirma con modificacion", "confirma la sentencia con la modificacion de que otorga el amparo", "regla")),
        (("POR TANTO: I) Confirma la sentencia, salvo la multa por la autoridad impugnada.",), ("altera", "confirma con modificacion", "confirma la sentencia, salvo la multa por la autoridad impugnada", "regla")),
        (("POR TANTO: I) Por ausencia temporal del magistrado se integra el tribunal. II) Sin lugar el recurso de apelación.",), ("mantiene", "sin lugar la apelacion", "sin lugar el recurso de apelacion", "regla")),
        (("Esta Corte declara: I) Con lugar la apelación; en consecuencia, deja sin efecto lo actuado.",), ("altera", "con lugar la apelacion", "con lugar la apelacion; en consecuencia, deja sin efecto lo actuado", "regla")),
        (("resuelve: I) Deniega el amparo solicitado por la postulante.",), ("sin_decision_inferior", "resuelve el amparo en unica instancia", "deniega el amparo solicitado por la postulante", "regla")),
        (("resuelve: I) Sin lugar la solicitud de aclaración.",), ("aclaracion_ampliacion", "auto de aclaracion o ampliacion", "sin lugar la solicitud de aclaracion", "regla")),
        (("POR TANTO: I) Confirma con modificación la sentencia.",), ("altera", "modifica", "confirma con modificacion la sentencia", "regla")),
        (("POR TANTO: I) Inadmisible el recurso.",), ("no_entra_al_fondo", "no entra al fondo", "inadmisible el recurso", "regla")),
        (("POR TANTO: I) Anula lo actuado y confirma lo demás.",), ("altera", "anula", "anula lo actuado y confirma lo demas", "regla")),
        # the opinion that follows decides nothing, so the clause before it counts
        (("resuelve: I) Confirma la sentencia apelada. VOTO RAZONADO: la Sala resuelve: como consta en autos.",), ("mantiene", "confirma", "confirma la sentencia apelada. voto razonado: la sala resuelve: como consta en autos", "regla")),
        (("POR TANTO: certifíquese lo conducente.",), ("ambiguo", None, None, None)),
        (("Sin parte dispositiva alguna: confirma, revoca y anula.",), ("no_hallado", None, None, None)),
        ((None,), ("no_hallado", None, None, None)),
    ],
    lambda d: fields(c("r"), "effect", "rule", "point", "source"),
    lambda d: d.withColumn("r", ruling.kept(ruling.read_ruling(c("text")))),
)

_TWO = "APELACIÓN DE SENTENCIA DE AMPARO\nCORTE DE CONSTITUCIONALIDAD: Guatemala, veintitrés de febrero de dos mil dieciséis. En apelación y con sus antecedentes, se examina la sentencia de seis de noviembre de dos mil quince, dictada por la Sala Primera."
_NO_PERIOD = "Guatemala, tres de marzo de mil novecientos noventa y nueve En apelación"
known(
    "q11_word_dates", "orders", "o_orderkey", "text string", ["decided", "anchored", "quote"],
    [
        ((_TWO,), (date(2016, 2, 23), True, "veintitrés de febrero de dos mil dieciséis")),
        (("Visto el uno de enero de dos mil. CORTE DE CONSTITUCIONALIDAD, EN CALIDAD DE TRIBUNAL EXTRAORDINARIO DE AMPARO: Guatemala, veintidós de abril de mil novecientos noventa y siete. Se tiene a la vista.",), (date(1997, 4, 22), True, "veintidós de abril de mil novecientos noventa y siete")),
        (("Dictada el uno de enero de dos mil. CORTE DE CONSTITUCIONALIDAD: Guatemala dos de mayo de dos mil tres.",), (date(2003, 5, 2), True, "dos de mayo de dos mil tres")),
        (("Sentencia de tres de marzo de dos mil diez.",), (date(2010, 3, 3), False, "tres de marzo de dos mil diez")),
        ((_NO_PERIOD,), (date(1999, 3, 3), False, "tres de marzo de mil novecientos noventa y nueve")),
        (("Resolucion de 01/03/2004 del tribunal",), (date(2004, 3, 1), False, "01/03/2004")),
        (("31/02/2004 y 1-3-2004",), (date(2004, 3, 1), False, "1-3-2004")),
        (("treinta y uno de febrero de dos mil trece",), (None, None, None)),
        (("treinta y uno de febrero de dos mil trece, luego dos de julio de dos mil dos",), (date(2002, 7, 2), False, "dos de julio de dos mil dos")),
        (("el veintisiete de junio de dos mil siete y dos de julio",), (date(2007, 6, 27), False, "veintisiete de junio de dos mil siete")),
        (("el veintidós de diciembre de dos mil veintiuno y cinco de enero",), (date(2021, 12, 22), False, "veintidós de diciembre de dos mil veintiuno")),
        (("treinta y uno de agosto de mil novecientos noventa y ocho",), (date(1998, 8, 31), False, "treinta y uno de agosto de mil novecientos noventa y ocho")),
        (("el dieciséis de mayo del dos mil cinco.",), (date(2005, 5, 16), False, "dieciséis de mayo del dos mil cinco")),
        (("el dieciséis de diciembre dos mil diecinueve, en esta Corte",), (date(2019, 12, 16), False, "dieciséis de diciembre dos mil diecinueve")),
        (("presentado eltres de junio de dos mil dieciséis,en el Centro",), (date(2016, 6, 3), False, "tres de junio de dos mil dieciséis")),
        (("el treinta de diciembrede dos mil quince",), (date(2015, 12, 30), False, "treinta de diciembrede dos mil quince")),
        (("elveintiocho de marzodedos mil dieciséis, enla Sala",), (date(2016, 3, 28), False, "veintiocho de marzodedos mil dieciséis")),
        (("el ocho de junio del año dos mil uno",), (date(2001, 6, 8), False, "ocho de junio del año dos mil uno")),
        (("el catorce de marzo del año en curso",), (None, None, None)),
        (("ventidos de mayo de dos mil uno",), (None, None, None)),
        (("CORTE DE CONSTITUCIONALIDAD: Guatemala, sin fecha. Antes, 2/5/2001.",), (date(2001, 5, 2), False, "2/5/2001")),
        ((None,), (None, None, None)),
    ],
    lambda d: {"decided": c("r.date"), "anchored": c("r.anchored"), "quote": c("r.quote")},
    lambda d: d.withColumn("r", dates.resolution_date(c("text"))),
)

_DIFFERS = "la fecha del encabezado difiere de la del portal"
known(
    "q12_filing_alerts", "orders", "o_orderkey", "text string, usable boolean, portal date, case string", ["state", "filed", "quote", "in_court", "alerts", "resolved", "anchored", "note"],
    [
        (("ANTECEDENTES I. EL AMPARO A) Interposición y autoridad: presentado el\nveinticuatro de febrero de dos mil siete, en el Juzgado Primero de Paz de Turno y,\nposteriormente, remitido a la Sala. B) Acto reclamado: resolución de diez de\nenero de dos mil siete.", True, date(2007, 9, 1), "3-2007"), ("ok", date(2007, 2, 24), "veinticuatro de febrero de dos mil siete", False, "", date(2007, 2, 24), False, _DIFFERS)),
        (("A) Solicitud y autoridad: presentado el siete de julio de dos mil diecisiete, en esta Corte. B) Acto reclamado: resolución de diez de abril de dos mil diecisiete.", True, None, "10-2017"), ("ok", date(2017, 7, 7), "siete de julio de dos mil diecisiete", True, "", date(2017, 7, 7), False, None)),
        (("A) Solicitud y autoridad: presentados, respectivamente, el veinte y treinta y uno de agosto de dos mil quince, en esta Corte. B) Actos reclamados: ...", True, date(2015, 8, 31), "1-2015"), ("varias_acciones", None, None, True, None, date(2015, 8, 31), False, None)),
        (("A) Interposición: presentados el uno de enero de dos mil y el dos de mayo de dos mil uno. B) Acto.", True, None, "1-2001"), ("varias_acciones", None, None, False, None, date(2000, 1, 1), False, None)),
        (("A) Interposición: la interpusieron el uno de enero de dos mil. B) Acto.", True, None, "1-2001"), ("varias_acciones", None, None, False, None, date(2000, 1, 1), False, None)),
        (("ANTECEDENTES I. FUNDAMENTOS JURÍDICOS DE LA IMPUGNACIÓN a) el veintiséis de febrero de mil novecientos noventa y ocho, el Congreso aprobó el Decreto 15-98.", True, None, "15-98"), ("sin_apartado", None, None, None, None, date(1998, 2, 26), False, None)),
        (("A) Solicitud: presentada en su oportunidad, 1/1/2001. B) Acto: del dos de enero de dos mil uno.", True, None, "7-01"), ("apartado_sin_fecha", None, None, False, None, date(2001, 1, 2), False, None)),
        (("A) Presentación: el uno de junio de dos mil cuatro. B) x", False, None, "7-04"), ("revision_humana", None, None, None, None, None, None, None)),
        (("CORTE DE CONSTITUCIONALIDAD: Guatemala, dos de febrero de dos mil cuatro. A) Solicitud: presentado el uno de junio de dos mil cuatro ante la Corte de Constitucionalidad. B) x", True, date(2005, 1, 1), "1173-2004"), ("ok", date(2004, 6, 1), "uno de junio de dos mil cuatro", True, "presentacion_posterior_a_la_resolucion", date(2004, 2, 2), True, _DIFFERS)),
        (("A) Interposición: presentado el treinta y uno de octubre de mil dos. B) x", True, None, "1523-2001"), ("ok", date(1002, 10, 31), "treinta y uno de octubre de mil dos", False, "anio_de_presentacion_imposible; presentacion_mas_de_5_anios_antes_del_expediente", date(1002, 10, 31), False, None)),
        (("A) Interposición: presentado el cinco de enero de dos mil diecinueve. B) x", True, date(2018, 3, 1), "100-2018"), ("ok", date(2019, 1, 5), "cinco de enero de dos mil diecinueve", False, "presentacion_posterior_a_la_resolucion; presentacion_posterior_al_anio_del_expediente", date(2019, 1, 5), False, _DIFFERS)),
        (("A) Interposición: presentado el veintidós de marzo de dos mil tres. B) x", True, None, "3171-2011"), ("ok", date(2003, 3, 22), "veintidós de marzo de dos mil tres", False, "presentacion_mas_de_5_anios_antes_del_expediente", date(2003, 3, 22), False, None)),
        # without an end the section is 400 characters long
        (("A) Interposición: " + "sin fecha alguna, " * 25 + "el uno de junio de dos mil cuatro.", True, None, "7-04"), ("apartado_sin_fecha", None, None, False, None, date(2004, 6, 1), False, None)),
    ],
    lambda d: {"alerts": joined(c("r.alerts"))} | fields(c("r"), "state", "filed", "quote", "in_court", "resolved", "anchored", "note"),
    lambda d: d.withColumn("r", dates.filing_record(c("text"), c("usable"), c("portal"), c("case"))),
)

known(
    "q43_number_words", "customer", "c_custkey", "phrase string", ["n"],
    [((p,), (n,)) for p, n in (("dos mil trece", 2013), ("dos mil cuatro", 2004), ("mil novecientos noventa y ocho", 1998), ("mil novecientos ochenta y siete", 1987), ("dos mil dieciseis", 2016), ("treinta y uno", 31), ("veintitrés", 23), ("primero", 1), ("CIENTO VEINTIDÓS", 122), ("dos-mil-uno", 2001), ("mil", 1000), ("aproximadamente dos mil", None), ("dos mil y pico", None), ("", None), (" y ", None), (None, None))],
    lambda d: {"n": dates.number_words(c("phrase"))},
)

known(
    "q44_case_numbers", "customer", "c_custkey", "c string", ["year", "reason", "filing_year", "variants"],
    [
        (("5577-2015",), (2015, None, 2015, "5577-2015,5577-15")), (("61-98",), (1998, None, 1998, "61-98,61-1998")), (("11-87",), (1987, None, 1987, "11-87,11-1987")), (("1670-2001 ",), (2001, None, 2001, "1670-2001,1670-01")),
        ((" 61-98 ",), (1998, None, 1998, "61-98,61-1998")), (("1-86",), (1986, None, 1986, "1-86,1-1986")), (("1-00",), (2000, None, 2000, "1-00,1-2000")), (("12-05",), (2005, None, 2005, "12-05,12-2005")), (("196-69",), (None, "fuera del periodo", 1969, "196-69,196-2069")),
        (("1298-200",), (None, "longitud del anio", 200, "1298-200")), (("1014-1996a",), (None, "no numerico", None, "1014-1996a")), (("singuion",), (None, "sin guion", None, "singuion")), (("4-2099",), (None, "fuera del periodo", 2099, "4-2099,4-99")),
    ],
    lambda d: fields(casenum.year_of(c("c"), AS_OF), "year", "reason") | {"filing_year": casenum.filing_year(c("c")), "variants": joined(casenum.variants(c("c")), ",")},
)

known(
    "q45_outcomes", "customer", "c_custkey", "sense string, clause string", ["by_sense", "by_clause"],
    [
        (("Con Lugar -Derecho de Propiedad", "I) deniega el amparo solicitado; II) condena en costas"), ("con_lugar", "denegado")), (("Sin Lugar -Ausencia de agravio", "confirma la sentencia venida en grado"), ("sin_lugar", "confirmado")),
        (("Sin Lugar -Extemporaneidad", "I) sin lugar los recursos de apelación"), ("sin_lugar", "sin_lugar")), (("Algo que no existe", "por notoriamente improcedente, deniega"), (None, "rechazado")), (("Se Deniega", "I) deniega el amparo; II) confirma lo demas"), ("denegado", "denegado")),
        (("Archivado", "se archiva"), ("archivo_sobreseimiento", "archivo_sobreseimiento")), (("Sobreseído", "sobresee el proceso"), (None, "archivo_sobreseimiento")), (("Otro - con lugar", "nada de eso"), (None, None)), (("Inadmisible", "inadmisible; suspende"), ("inadmitido", "inadmitido")),
        (("Suspende", "SUSPENDE lo actuado"), ("suspendido", "suspendido")), ((None, None), (None, None)), (("", ""), (None, None)),
    ],
    lambda d: {"by_sense": rules.outcome_of_sense(c("sense")), "by_clause": rules.outcome_of_clause(c("clause"))},
)

_REVIEW, _SOLE = "Apelación de Sentencia de Amparo", "Amparo en Única Instancia"
known(
    "q46_procedural_effects", "customer", "c_custkey", "outcome string, kind string", ["effect"],
    [((o, k), (e,)) for o, k, e in (
        ("sin_lugar", _REVIEW, "mantiene_decision_inferior"), ("denegado", _REVIEW, "mantiene_decision_inferior"), ("confirmado", _REVIEW, "mantiene_decision_inferior"), ("con_lugar", _REVIEW, "altera_decision_inferior"), ("revocado", _REVIEW, "altera_decision_inferior"), ("otorgado", "Recurso de casación", "altera_decision_inferior"),
        ("inadmitido", _REVIEW, "no_entra_al_fondo"), ("rechazado", _REVIEW, "no_entra_al_fondo"), ("suspendido", _REVIEW, "suspende_actuacion"), ("archivo_sobreseimiento", _REVIEW, "termina_proceso"), ("otro", _REVIEW, None), (None, _REVIEW, None), ("confirmado", _SOLE, None), ("rechazado", _SOLE, "no_entra_al_fondo"),
        ("archivo_sobreseimiento", _SOLE, "termina_proceso"), ("suspendido", None, "suspende_actuacion"), ("confirmado", None, None),
    )],
    lambda d: {"effect": rules.procedural_effect(c("outcome"), c("kind"))},
)

known(
    "q47_petitioners", "customer", "c_custkey", "text string", ["name", "label", "fragment"],
    [
        (("en la acción constitucional de amparo promovida por Grupo Eco, Sociedad Anónima, por medio del Mandatario Especial, contra la Sala Tercera.",), ("Grupo Eco, Sociedad Anónima", "Empresa", "sociedad anonima")),
        (("en la acción constitucional de amparo promovida porInter, Sociedad Anónima, por medio de su gerente, contra laSala Tercera.",), ("Inter, Sociedad Anónima", "Empresa", "sociedad anonima")),
        (("en la acción constitucional de amparo que promovió la Comisión Internacional contra la Impunidad en Guatemala por medio de sus Mandatarias, contra la Sala.",), ("la Comisión Internacional contra la Impunidad en Guatemala", "Otra entidad pública", "comision internacional contra la impunidad")),
        (("la acción constitucional homónima que Pantaleón, Sociedad Anónima, promovió contra la Comisión Nacional de Energía Eléctrica.",), ("Pantaleón, Sociedad Anónima", "Empresa", "sociedad anonima")),
        (("en la acción de amparo promovida por Delfina Olivares Retana, quien actuó con la dirección del abogado David Sentes Luna.",), ("Delfina Olivares Retana", "Persona u otro (residual)", None)),
        (("Se conoce el recurso de apelación interpuesto por el Ministerio Público contra la sentencia dictada en el amparo promovido por Claudio Ramírez Pérez contra el Juez.",), ("Claudio Ramírez Pérez", "Persona u otro (residual)", None)),
        (("amparo promovido por el postulante contra el Juez.",), (None, "Vacío", None)),
        (("amparo promovido por el Ministerio Público contra el Juez.",), ("el Ministerio Público", "Ministerio Público", "ministerio publico")),
        (("amparo promovido por el Banco de Guatemala contra el Juez.",), ("el Banco de Guatemala", "Otra entidad pública", "banco de guatemala")),
        (("amparo promovido por Unipharm, S. A., contra el Juez.",), ("Unipharm, S. A.", "Empresa", "s. a.")),
        (("amparo promovido por la Asociación de la Industria del Vestuario y Textiles contra el Juez.",), ("la Asociación de la Industria del Vestuario y Textiles", "Gremial / cámara", "asociacion de la industria")),
        (("Sentencia sin el párrafo de apertura habitual.",), (None, "Vacío", None)),
        ((None,), (None, "Vacío", None)),
    ],
    lambda d: {"name": c("name")} | fields(rules.PETITIONERS.classify(c("name")), "label", "fragment"),
    lambda d: d.withColumn("name", rules.petitioner(c("text"))),
)

known(
    "q48_human_verdicts", "customer", "c_custkey", "token string, prose string", ["verdict"],
    [(a, (b,)) for a, b in ((("mantiene", "revoca y altera"), "mantiene"), ((" Altera ", "no altera"), "altera"), (("no_aplica", "altera"), "otro"), (("", "Sin lugar y mantiene."), "mantiene"), ((None, "No  altera nada"), "mantiene"), (("quizá", "Sí altera"), "altera"), (("", "se confirma"), "mantiene"), (("", "Otro caso"), "otro"), (("", "ninguno"), None), (("", " "), None), ((None, None), None))],
    lambda d: {"verdict": rules.controlled_verdict(c("token"), c("prose"))},
)

known(
    "q49_own_votes", "customer", "c_custkey", "text string", ["own", "foreign_only", "mentions"],
    [
        (("voto disidente de la sala. POR TANTO: resuelve: confirma. Voto  razonado del magistrado.",), (True, False, 2)), (("la sala emitió voto disidente. POR TANTO: confirma.",), (False, True, 1)), (("un voto concurrente, sin más",), (False, True, 1)),
        (("POR TANTO: confirma.",), (False, False, 0)), (("resuelve: a. voto razonado. resuelve: b.",), (False, True, 1)), ((None,), (False, False, 0)),
    ],
    lambda d: fields(rules.own_vote(c("text")), "own", "foreign_only", "mentions"),
)

known(
    "q50_text_forms", "customer", "c_custkey", "s string", ["stripped", "plain", "quotable", "letters", "tokens", "tail"],
    [
        (("Dvořák, Ñandú y  Ệ",), ("Dvorak, Nandu y  E", "dvorak, nandu y e", "dvorak, nandu y e", "DVORAKNANDUYE", "DVORAK,NANDU,E", "dú y Ệ")),
        (("===PAGINA 3===\nsetenta y dos-\nnoventa",), ("===PAGINA 3===\nsetenta y dos-\nnoventa", "===pagina 3=== setenta y dos- noventa", "setenta y dos-noventa", "PAGINASETENTAYDOSNOVENTA", "PAGINA,SETENTA,DOS,NOVENTA", "oventa")),
        (("é a\tb",), ("e a\tb", "e a b", "e a b", "EAB", "E,A,B", "é a b")),
        (("María de los Ángeles",), ("Maria de los Angeles", "maria de los angeles", "maria de los angeles", "MARIADELOSANGELES", "MARIA,ANGELES", "ngeles")),
        (("",), ("", "", "", "", "", "")),
        ((None,), (None, None, None, None, None, None)),
    ],
    lambda d: {"stripped": text.strip_accents(c("s")), "plain": text.plain(c("s")), "quotable": text.quotable(c("s")), "letters": text.letters(c("s")), "tokens": joined(text.name_tokens(c("s")), ","), "tail": text.tail(c("s"), 6)},
)

SOUND = (
    "CORTE DE CONSTITUCIONALIDAD: Guatemala, treinta y uno de octubre de dos mil trece. En apelacion y con sus antecedentes, se examina la sentencia dictada "
    "por la Sala Tercera de la Corte de Apelaciones de Trabajo, constituida en Tribunal de Amparo, en la accion constitucional de amparo promovida por el "
    "Estado de Guatemala contra el Juez Sexto de Primera Instancia del Ramo Civil del departamento de Guatemala. El amparo se otorga porque la autoridad "
    "impugnada omitio fundamentar su decision, con lo que vulnero el derecho de defensa que garantiza la Constitucion Politica de la Republica. "
) * 6
_without = lambda letters: SOUND.translate(str.maketrans("", "", letters + letters.upper()))
_NO_LETTERS = "letras casi ausentes frente a lo esperado en espanol: "
known(
    "q51_text_layers", "supplier", "s_suppkey", "text string", ["verdict", "lost", "tokens", "prose", "whole"],
    [
        ((SOUND,), ("usable", "", 564, True, True)), ((_without("mgw"),), ("sospechoso", "g,m", 564, True, True)), ((_without("l"),), ("sospechoso", "l", 564, True, True)), ((_without("w"),), ("usable", "", 564, True, True)),
        ((" ".join(" ".join(w) for w in SOUND.split()),), ("sospechoso", "", 2910, True, False)), ((SOUND.replace("o", "ó"),), ("usable", "", 564, True, True)), (("de la en el un se " * 60 + SOUND,), ("usable", "", 924, True, True)),
        ((" ".join(f"registro{i} valor{i}" for i in range(400)),), ("sospechoso", "b,c,d,m,n,p,q,u,y", 800, False, True)), (("",), ("sin_capa_de_texto", "", 0, True, True)), (("1\n\f2\n\f3\n",), ("sin_capa_de_texto", "", 0, True, True)), ((None,), ("sin_capa_de_texto", "", 0, True, True)),
    ],
    lambda d: fields(c("q"), "verdict", "tokens") | {"lost": joined(c("q.lost_letters"), ","), "prose": ~F.exists("q.reasons", lambda r: r.contains("prosa")), "whole": ~F.exists("q.reasons", lambda r: r.contains("partido"))},
    lambda d: textquality.assess(d, "text", "q"),
)

#: A register with one person of two terms, another of two spellings, and one whose term begins on a day of change.
OFFICERS = [
    ("Roberto Antonio Molina Barreto", 2006, 2011), ("Dina Josefina Ochoa Escribá", 2016, 2026), ("Roberto Molina Barreto", 2021, 2026), ("Juan Francisco Flores Juárez", 2001, 2006), ("Héctor Luis Flores Hernández", 2001, 2006),
    ("Gloria Evangelina Melgar Rojas de Aguilar", 2001, 2006), ("Julia Marisol Rivera Aguilar", 2026, 2031),
]
known(
    "q16_in_office", "orders", "o_orderkey", "text string, decided date", ["signers"],
    [
        (("II) Notifíquese. Firmado digitalmente por ROBERTO MOLINA BARRETO Fecha: 21/09/2023 Firmado digitalmente por DINA JOSEFINA OCHOA ESCRIBA Fecha: 21/09/2023", date(2023, 9, 21)), ("Roberto Antonio Molina Barreto; Dina Josefina Ochoa Escribá",)),
        (("Notifíquese. DIN A JOSEFIN A OCH OA ESCR IBÁ MAGISTRADA", date(2019, 5, 6)), ("Dina Josefina Ochoa Escribá",)),
        (("Notifíquese. ROBERTO DINA MOLINA JOSEFINA BARRETO MAGISTRADO", date(2024, 3, 1)), ("Roberto Antonio Molina Barreto",)),
        (("Notifíquese. ROBERTO DINA MOLINA JOSEFINA BARRETO MAGISTRADO", date(2014, 3, 1)), ("",)),
        (("Notifíquese. JUAN FRANCISCO FLORES JUÁREZ PRESIDENTE LUIS DE JESÚS HERNÁNDEZ TORRES SECRETARIO GENERAL", date(2005, 8, 23)), ("Juan Francisco Flores Juárez",)),
        (("Notifíquese. JULIA MARISOL RIVERA AGUILAR MAGISTRADA", date(2026, 4, 13)), ("",)), (("Notifíquese. JULIA MARISOL RIVERA AGUILAR MAGISTRADA", date(2026, 4, 14)), ("Julia Marisol Rivera Aguilar",)),
        (("Notifíquese. GLORIA MELGAR DE AGUILAR MAGISTRADA", date(2005, 1, 1)), ("Gloria Evangelina Melgar Rojas de Aguilar",)),
        (("Firma GLORIA MELGAR DE AGUILAR. Notifíquese. JUAN FRANCISCO FLORES JUÁREZ", date(2007, 4, 13)), ("Juan Francisco Flores Juárez",)),
        (("sin cierre, FLORES JUÁREZ", date(2005, 1, 1)), ("Juan Francisco Flores Juárez",)), (("Notifíquese. Sin firmas.", date(2005, 1, 1)), ("",)), ((None, date(2005, 1, 1)), ("",)), (("Notifíquese. JUAN FRANCISCO FLORES JUÁREZ", None), ("",)),
    ],
    lambda d: {"signers": joined(c("signers"))},
    lambda d: people.signers(d, people.people(d.sparkSession.createDataFrame([(*o, i) for i, o in enumerate(OFFICERS)], "name string, since int, until int, ord int"))),
)

_EXPECT = {"api": responses.API, "card": responses.CARD, "pdf": responses.PDF, "docx": responses.DOCX, "words": responses.Expectation("html", 1, "text/html", min_words=40)}
_CARD_PAGE = "<html><body><p>" + "relleno " * 2000 + "</p>Atributos del Expediente<table><tr><td>No. Expediente</td><td>1-2000</td></tr></table></body></html>"
known(
    "q21_fetch_outcome", "pages", "page_id", "status int, body string, content_type string, wants string", ["outcome", "note"],
    [
        ((200, "", "application/json", "api"), ("empty_body", "HTTP 200 con cuerpo vacio")), ((202, "", "application/json", "api"), ("empty_body", "HTTP 202 con cuerpo vacio")), ((200, "palabra " * 20, "text/html", "words"), ("suspiciously_short", "20 palabras, minimo esperado 40")),
        ((200, '{"documentos": [], "recordsTotal": 0, "recordsFiltered": 0}', "application/json", "api"), ("ok", None)), ((200, "<html>error</html>" * 200, "text/html", "pdf"), ("wrong_content_type", "content-type 'text/html', se esperaba 'application/pdf'")),
        ((200, "x" * 5000, "application/pdf", "pdf"), ("suspiciously_short", "falta el marcador '%PDF-'")), ((200, '{"documentos": [{"id": 79', "application/json", "api"), ("suspiciously_short", "JSON invalido")), ((403, "<title>Just a moment...</title>", "text/html", "card"), ("blocked_by_challenge", "desafio anti-bot en HTTP 403")),
        ((403, "no", "text/html", "card"), ("http_error", "HTTP 403")), ((503, "Just a moment...", "text/html", "card"), ("http_error", "HTTP 503")), ((200, "Checking your browser", "text/html", "card"), ("blocked_by_challenge", "desafio anti-bot: 'Checking your browser'")),
        ((200, "<p>relleno relleno relleno</p>" * 500, "text/html", "card"), ("suspiciously_short", "falta el marcador 'Atributos del Expediente'")), ((200, _CARD_PAGE, "Text/HTML; charset=utf-8", "card"), ("ok", None)), ((200, "[]", "application/json", "api"), ("wrong_content_type", "el JSON raiz no es un objeto")),
        ((200, '{"documentos": []}', "application/json", "api"), ("wrong_content_type", "faltan claves ['recordsTotal']")), ((200, "%PDF-1.4", "application/pdf", "pdf"), ("suspiciously_short", "8 bytes, minimo esperado 2048")), ((200, "PK" + "x" * 3000, "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "docx"), ("ok", None)),
        ((200, "a captcha is named here " * 200, "text/html", "words"), ("ok", None)), ((None, None, None, "pdf"), ("not_checked", "sin respuesta")), ((200, "x", None, "pdf"), ("wrong_content_type", "content-type '', se esperaba 'application/pdf'")),
    ],
    lambda d: fields(F.coalesce(*[F.when(c("wants") == w, responses.fetch_outcome(c("status"), c("body"), c("content_type"), e)) for w, e in _EXPECT.items()]), "outcome", "note"),
)

known(
    "q52_parse_routes", "customer", "c_custkey", "readable boolean, producer string, creator string, verdict string, ocr_done boolean, ocr_verdict string", ["scanner", "without_ocr", "with_ocr", "usable"],
    [
        ((True, "Microsoft(R) Word 2016", None, "usable", None, None), (False, "capa_nativa", "capa_nativa", True)), ((True, "LeanScan 3.5", None, "usable", True, "usable"), (True, "revision_humana", "ocr_por_productor", True)), ((True, "Word", None, "sin_capa_de_texto", True, "usable"), (False, "revision_humana", "ocr_por_ausencia", True)),
        ((True, "Word", None, "sospechoso", True, "usable"), (False, "revision_humana", "ocr_por_calidad", True)), ((True, "Word", None, "sin_capa_de_texto", True, "sospechoso"), (False, "revision_humana", "revision_humana", False)), ((True, "Word", None, "sin_capa_de_texto", False, None), (False, "revision_humana", "no_comprobado", False)),
        ((False, None, None, None, None, None), (False, "no_comprobado", "no_comprobado", False)), ((True, "Adobe PDF Library 23.6.96; modified using iTextSharp™ 5.5.8", "Acrobat PDFMaker 23 para Word", "usable", None, None), (False, "capa_nativa", "capa_nativa", True)), ((True, "SHARP MX-M365N", None, "usable", True, "usable"), (True, "revision_humana", "ocr_por_productor", True)),
        ((True, None, "ABBYY FineReader 12", "usable", True, "usable"), (True, "revision_humana", "ocr_por_productor", True)), ((True, "Tesseract 5.3.0", None, "usable", None, None), (True, "revision_humana", "no_comprobado", False)), ((True, None, None, "usable", None, None), (False, "capa_nativa", "capa_nativa", True)),
    ],
    lambda d: {"scanner": c("scanner"), "without_ocr": responses.parse_route(c("readable"), c("scanner"), c("verdict"))["route"], "with_ocr": c("route"), "usable": responses.usable_route(c("route"))},
    lambda d: d.withColumn("scanner", responses.by_scanner(c("producer"), c("creator"))).withColumn("route", responses.parse_route(c("readable"), c("scanner"), c("verdict"), "on", c("ocr_done"), c("ocr_verdict"))["route"]),
)

HOSTS, HOST = ["203.0.113.7", "192.0.2.10", "198.51.100.3"], "docs.example.org"
known(
    "q19_url_normalise", "pages", "page_id", "raw string", ["url", "rewritten", "again", "format"],
    [((raw,), (url, rewritten, False, kind)) for raw, url, rewritten, kind in (
        ("http://203.0.113.7/Sentencias/1.pdf", "https://docs.example.org/Sentencias/1.pdf", True, "pdf"), ("http://192.0.2.10:8080/a/798734.1920-2003 AC.pdf", "https://docs.example.org/a/798734.1920-2003%20AC.pdf", True, "pdf"),
        ("https://docs.example.org/a/798734.1920-2003%20AC.pdf", "https://docs.example.org/a/798734.1920-2003%20AC.pdf", False, "pdf"), ("http://docs.example.org/x.DOC", "https://docs.example.org/x.DOC", True, "doc"), ("http://otro.invalid/x.pdf", "http://otro.invalid/x.pdf", False, "pdf"),
        ("http://otro.invalid/año 1/x.docx?q=a b#f g", "http://otro.invalid/a%C3%B1o%201/x.docx?q=a b#f g", True, "pdf"), ("http://198.51.100.3/a(1),b;c=~'!$&*+@:.docx", "https://docs.example.org/a(1),b;c=~'!$&*+@:.docx", True, "docx"), ("http://docs.example.org:8080/x", "http://docs.example.org:8080/x", False, "pdf"),
        ('https://docs.example.org/"<>"^|`.pdf', "https://docs.example.org/%22%3C%3E%22%5E%7C%60.pdf", True, "pdf"), ("/solo/camino", "/solo/camino", False, "pdf"),
    )],
    lambda d: fields(c("u"), "url", "rewritten") | {"again": responses.canonical_url(c("u.url"), HOSTS, HOST)["rewritten"], "format": responses.format_of(c("u.url"))},
    lambda d: d.withColumn("u", responses.canonical_url(c("raw"), HOSTS, HOST)),
)

known(
    "q53_lenient_fields", "customer", "c_custkey", "day string, moment string, topics string", ["decided", "published", "topic_list", "warned"],
    [
        (("2013-10-31T00:00:00Z", "2013-11-02T10:20:30Z", '["a","b"]'), (date(2013, 10, 31), "2013-11-02 10:20:30", "a|b", "")),
        (("2013-10-31", "2013-11-02T10:20:30", "null"), (date(2013, 10, 31), "2013-11-02 10:20:30", None, "")),
        (("31/10/2013", "2013-11-02T10:20:30-06:00", '"solo"'), (None, "2013-11-02 16:20:30", "solo", "decided no interpretable: '31/10/2013'; topics llego como escalar y no como lista: \"solo\"")),
        (("2013-02-30", "ayer", "7"), (None, None, "7", "decided no interpretable: '2013-02-30'; published no interpretable: 'ayer'; topics llego como escalar y no como lista: 7")),
        (("", None, None), (None, None, None, "")), (("2013-10-31T23:59:59-06:00", "2013-11-02", "[]"), (date(2013, 10, 31), "2013-11-02 00:00:00", "", "")),
    ],
    lambda d: {"decided": c("a.value"), "published": F.date_format("b.value", "yyyy-MM-dd HH:mm:ss"), "topic_list": joined(c("t.value"), "|"), "warned": joined(discovery.warnings(c("a"), c("b"), c("t")))},
    lambda d: d.withColumns({"a": discovery.iso_date(c("day"), "decided"), "b": discovery.iso_time(c("moment"), "published"), "t": discovery.as_list(c("topics"), "topics")}),
)

_NAMES = lambda *names: F.array(*names)
known(
    "q54_verification", "customer", "c_custkey", "document string, quote string, provenance string, one string, two string", ["status", "names", "missing", "note"],
    [
        (("Uno ===PAGINA 2=== dos - tres Árbol. José Pérez, Ana Gil", "uno dos-tres arbol", "llm", "JOSE PEREZ", "Ana Gil"), ("verificada", "verificada", "", "n")), (("Uno dos tres. Ana Gil", "uno tres", "llm", "Ana Gil", "Luis"), ("no_encontrada", "no_encontrada", "Luis", "n; EVIDENCIA no_encontrada: sin detalle")),
        (("Uno dos", None, "llm", "Uno", "Uno"), ("sin_evidencia", "verificada", "", "n; EVIDENCIA sin_evidencia: sin detalle")), (("Uno dos", None, "portal", "dos", "tres"), ("verificada", "no_encontrada", "tres", "n")), (("setenta y dos-\nnoventa", "dos-noventa", "llm", "setenta", "dos"), ("verificada", "verificada", "", "n")),
        (("el fallo se confirma", "el fallo … confirma", "llm", "fallo", " "), ("no_encontrada", "no_encontrada", " ", "n; EVIDENCIA no_encontrada: sin detalle")),
    ],
    lambda d: {"status": c("status"), "names": c("v.status"), "missing": joined(c("v.missing"), ","), "note": evidence.annotate(F.lit("n"), c("status"))},
    lambda d: d.withColumn("status", F.coalesce(*[F.when(c("provenance") == p, evidence.verify_quote(evidence.extracted(F.lit("v"), 0.9, p, c("quote")), c("document"))) for p in ("llm", "portal")])).withColumn("v", extraction.verify_each(_NAMES(c("one"), c("two")), c("document"))),
)

known(
    "q55_identity", "customer", "c_custkey", "forward string, asked string, back string, id string", ["verdict", "same"],
    [
        (("61-98", "61-1998", "1", "1"), ("consistente", True)), (("62-98", "61-1998", "1", "1"), ("otro_expediente", False)), (("908-2008", "908-2009", "1", "1"), ("otro_expediente", False)), (("11-1987", "11-87", "2", "1"), ("otro_id", True)),
        ((None, "61-98", "1", "1"), ("no_comprobado", False)), (("1483-96", "1483-1996", None, "1"), ("no_comprobado", True)),
    ],
    lambda d: {"verdict": evidence.id_verdict(c("forward"), c("asked"), c("back"), c("id")), "same": F.coalesce(evidence.same_case(c("forward"), c("asked")), F.lit(False))},
)

known(
    "q56_model_values", "customer", "c_custkey", "value string, quote string, confidence double", ["day", "outcome", "confidence", "note"],
    [
        (("diez de diciembre de mil novecientos noventa y seis", "cita", 0.9), ("1996-12-10", None, 0.9, "valor no convertible: 'diez de diciembre de mil novecientos noventa y seis'")), (("1996-12-10", "cita", 0.9), ("1996-12-10", None, 0.9, "valor no convertible: '1996-12-10'")),
        (("I) deniega el amparo solicitado; II) condena en costas", "cita", 1.5), (None, "denegado", 1.0, "confianza fuera de rango (1.5), acotada")), (("Con_Lugar", "cita", -0.5), (None, "con_lugar", 0.0, "confianza fuera de rango (-0.5), acotada")), (("otro", "cita", float("nan")), (None, "otro", 0.0, "el modelo devolvio una confianza no numerica")),
        (("confirma", None, 0.9), (None, None, 0.0, "descartado sin cita: 'confirma'")), (("confirma", " ", 0.9), (None, None, 0.0, "descartado sin cita: 'confirma'")), (("confirma", "cita", 0.9), (None, "confirmado", 0.9, None)), ((None, None, None), (None, None, None, None)),
    ],
    lambda d: {"day": c("d.value"), "outcome": c("o.value"), "confidence": F.when(c("d.value").isNotNull(), c("d.confidence")).otherwise(c("o.confidence")), "note": c("o.note")},
    lambda d: (lambda a: d.withColumns({"d": extraction.said(a, extraction.as_date), "o": extraction.said(a, extraction.as_outcome)}))(F.struct("value", "quote", F.lit(1).alias("page"), "confidence")),
)

known(
    "q57_strata_and_years", "customer", "c_custkey", "effect string, rule string, stratum_year string, cases array<string>", ["stratum", "year", "source"],
    [
        (("mantiene", "confirma", "2010", ["1-2011"]), ("mantiene", 2010, "regla")), (("altera", "confirma con modificacion", None, ["1-2011", "2-2009"]), ("altera_regla_discutida", 2011, "regla")), (("altera", "revoca", None, ["x", "2-2009"]), ("altera_otras_reglas", None, "regla")), (("altera", None, None, ["61-98"]), ("altera_otras_reglas", 1998, None)),
        (("ambiguo", None, None, []), (None, None, None)), ((None, None, None, None), (None, None, None)),
    ],
    lambda d: {"stratum": studies.stratum_of(c("effect"), c("rule")), "year": studies.document_year(c("stratum_year"), c("cases"), AS_OF), "source": ruling.effect_source(c("rule"))},
)

# the same parsers over whole documents, with the cases planted in three of four
planted("q100_planted_rulings", "q10_ruling_reader", ("no_hallado", None, None, None))
planted("q101_planted_dates", "q11_word_dates", (None, None, None))
planted("q102_planted_filings", "q12_filing_alerts", ("revision_humana", *[None] * 7))
planted("q103_planted_signers", "q16_in_office", ("",))
planted("q104_planted_outcomes", "q45_outcomes", (None, None), at_start=True)
planted("q105_planted_petitioners", "q47_petitioners", (None, "Vacío", None), at_start=True)
planted("q106_planted_votes", "q49_own_votes", (False, False, 0))
