"""Hand-built course-guide pages (made from the selectors and labels, see FIXTURES.md)."""

NB = "\u00a0"
HOST = "https://dges.gov.pt/guias/"

INDEX_HTML = '<a href="indcurso.asp?letra=A">A</a><a href="other.asp?x=1">x</a>'
LETTER_HTML = '<a href="detcursopi.asp?codc=9003&code=3021">C</a><a href="detcursopi.asp?codc=9003">no</a>'
COURSE_HTML = (
    '<div id="caixa-orange"><div class="cab1">Engenharia X<b>!</b></div><div class="cab2">Instituto Y</div>'
    '<div class="inside2"><h2>Endereço e Contactos da Instituição</h2> Rua A, 1 <br>1000-001 Lisboa<br><br>'
    "Tel: 21 000 00 00, 21 000 00 01<br>Fax: 21 000 00 02<br>"
    '<a href="mailto:a@x.example; b@x.example">mail</a>'
    "<h2>Características do par Instituição/Curso</h2>Código: 3021/9003<br>Grau: Licenciatura - 1º ciclo<br>"
    "Área CNAEF: 523 Electrónica e automação<br>Duração: 6 Semestres<br>ECTS: 180<br>"
    "Tipo de Ensino: Universitário<br>Concurso: Nacional<br>Novo: z<br>"
    "<h2>Provas de Ingresso</h2>Uma das seguintes provas:<br>07 Física e Química<br>"
    + NB * 6 + "ou<br>16 Matemática<br>" + NB * 6 + "e<br>19 Matemática A<br><h2>Secção Nova</h2></div></div>"
)


def course_page(inst, course, name="Engenharia X", inst_name="Instituto Y", ects="180", duration="6 Semestres",
                exams_html=None, mail=True, cnaef="523 Electrónica e automação"):
    exams_html = exams_html if exams_html is not None else "Uma das seguintes provas:<br>07 Física e Química<br>"
    mail_html = '<a href="mailto:a@x.example; b@x.example">mail</a>' if mail else ""
    ects_html = f"ECTS: {ects}<br>" if ects is not None else ""
    return (
        f'<div id="caixa-orange"><div class="cab1">{name}</div><div class="cab2">{inst_name}</div>'
        '<div class="inside2"><h2>Endereço e Contactos da Instituição</h2>Rua B<br>'
        f"<br>Tel: 1 2<br>{mail_html}"
        f"<h2>Características do par Instituição/Curso</h2>Código: {inst}/{course}<br>"
        f"Área CNAEF: {cnaef}<br>Duração: {duration}<br>{ects_html}"
        f"<h2>Provas de Ingresso</h2>{exams_html}<h2>x</h2></div></div>"
    )


def fixture_rows():
    """(seq, url, content_type, body) with windows-1252 bodies."""
    rows = [
        (1, HOST + "indcurso.asp", "text/html", INDEX_HTML),
        (2, HOST + "indcurso.asp?letra=A", "text/html", LETTER_HTML),
        (3, HOST + "detcursopi.asp?codc=9003&code=3021", "text/html", COURSE_HTML),
    ]
    return [(s, u, ct, bytearray(h.encode("cp1252"))) for s, u, ct, h in rows]
